"""Cross-tokenizer alignment: groups of tokens of two tokenizers that cover the same bytes, by pointer jumping, and links between tokens that end together.

Both token streams of a text are laid over its bytes (a space and the text). Every token points to the farthest-right token of the other stream
that overlaps it, or to itself if none ends later (of two that end together, the second stream's). Doubling all successors at once,
``next = next[next]``, leads every token to the last one of its connected component in as many steps as the logarithm of the longest chain; tokens with
the same last token are one group. A group's last two tokens end together; they are its link.

Links are counted corpus-wide by pair of ids. A pair with at least 1 / HEAVY of all links is one of at most HEAVY pairs, so the table of those is small at
any size; it is broadcast, and the links of such pairs meet their counts without a shuffle. The rest is joined by pair, where no pair holds more than that share.

Defined results: a text that is null, empty, or not given back byte for byte by either tokenizer has no tokens: zeros, and '' for the groups; rows with equal ids or
texts are counted one by one; null ids are allowed; an empty table gives an empty table; only doc_id and text are looked at. A text is
encoded whole, at about 150 bytes of memory per byte.

The tokenizers' files are read by every task from ``folder``, which is there on all machines.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scholar_lake.llm import arrays
from scholar_lake.llm.common import settle

FOLDER = "/opt/tokenizers"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: So many pairs at most are broadcast, 17 bytes each.
HEAVY = 1 << 18
LONG = 100_000
#: Fixed value: how byte-level vocabularies split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DESCRIBED = ("row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
             "pairs array<bigint>")
_loaded: dict[str, tuple] = {}


def byte_level_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 characters as themselves and all other bytes as characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_tokenizer(path: str) -> tuple:
    """A function from texts to lists of ids, and the bytes of each id.

    In this vocabulary an id is the rank of its merge, so tiktoken encodes with it, four times as fast; texts of over LONG characters, among them such with
    long runs that its pattern cannot take, go to the file's own library. Both give the same ids (tested, for every code point).
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    alphabet = byte_level_alphabet()
    tokens = [b""] * made.get_vocab_size()
    for entry, i in made.get_vocab(with_added_tokens=False).items():
        tokens[i] = bytes(alphabet[c] for c in entry)
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens) if t}, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        return [fast.encode_ordinary(t) if len(t) <= LONG else made.encode(t, add_special_tokens=False).ids for t in texts]
    return encode, tokens


def piece_tokenizer(path: str) -> tuple:
    import sentencepiece
    made = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(made.get_piece_size()):
        piece = made.id_to_piece(i)
        tokens.append(bytes([int(piece[3:5], 16)]) if made.is_byte(i) else piece.replace("▁", " ").encode())
    return lambda texts: made.encode(texts, num_threads=1), tokens


def tokenizers(folder: str) -> tuple:
    if folder not in _loaded:
        _loaded[folder] = byte_level_tokenizer(os.path.join(folder, BYTE_LEVEL)), piece_tokenizer(os.path.join(folder, PIECES))
    return _loaded[folder]


def last_tokens(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """For each token of both streams (the first one's, then the second one's) the last token of its component."""
    follow = np.concatenate((np.searchsorted(b_ends, a_ends) + len(a_ends), np.searchsorted(a_ends, b_ends)))
    own = np.arange(len(a_ends), len(follow))
    together = a_ends[follow[own]] == b_ends
    follow[own[together]] = own[together]
    while True:
        further = follow[follow]
        if np.array_equal(further, follow):
            return follow
        follow = further


class Alphabets:
    """The ids of both tokenizers as text, with the sign that follows."""

    def __init__(self, a: int, b: int):
        self.a = a
        digits = [str(i) for i in (*range(a), *range(b))]
        self.text = np.array([d + sign for sign in ",|;" for d in digits], object)
        self.size = len(digits)

    def written(self, token: np.ndarray, sign: np.ndarray) -> list[str]:
        return self.text[token + self.size * sign].tolist()


def aligned(texts: list[str | None], folder: str) -> tuple[np.ndarray, ...]:
    """n_a, n_b, n_groups of each text, its groups as text ('' without tokens), and of all links (text, id of A, id of B)."""
    (encode_a, bytes_a), (encode_b, bytes_b) = tokenizers(folder)
    counts, groups = np.zeros((3, len(texts)), np.int64), [""] * len(texts)
    good, ids_a, ids_b = [], [], []
    filled = [i for i, t in enumerate(texts) if t]
    for i, a, b in zip(filled, encode_a([" " + texts[i] for i in filled]), encode_b([texts[i] for i in filled])):
        whole = b" " + texts[i].encode()
        if b"".join(map(bytes_a.__getitem__, a)) == whole == b"".join(map(bytes_b.__getitem__, b)):
            good.append(i)
            ids_a.append(np.array(a, np.int64))
            ids_b.append(np.array(b, np.int64))
    none = np.zeros(0, np.int64)
    if not good:
        return *counts, groups, none, none, none
    text = np.array(good)
    n_a, n_b = (np.array([len(x) for x in ids]) for ids in (ids_a, ids_b))
    a, b = np.concatenate(ids_a), np.concatenate(ids_b)
    lengths_a, lengths_b = (np.fromiter(map(len, t), np.int64, len(t)) for t in (bytes_a, bytes_b))
    last = last_tokens(np.cumsum(lengths_a[a]), np.cumsum(lengths_b[b]))
    ends = np.flatnonzero(last == np.arange(len(last)))  # one per group, in order
    group = np.searchsorted(ends, last)
    owner = np.concatenate((np.repeat(text, n_a), np.repeat(text, n_b)))
    counts[0, text], counts[1, text], counts[2] = n_a, n_b, np.bincount(owner[ends], minlength=len(texts))
    final_a = np.searchsorted(group[:len(a)], np.arange(len(ends)), "right") - 1
    # the groups in words: the ids of A and of B, each followed by its sign
    order = np.lexsort((np.arange(len(group)), group))
    sign = np.zeros(len(group), np.int64)
    sign[final_a], sign[ends] = 1, 2
    if folder + "/" not in _loaded:
        _loaded[folder + "/"] = Alphabets(len(bytes_a), len(bytes_b))
    words = _loaded[folder + "/"].written(np.concatenate((a, b + len(bytes_a)))[order], sign[order])
    stops = np.cumsum(n_a + n_b).tolist()
    for i, begin, stop in zip(good, [0, *stops], stops):
        groups[i] = "".join(words[begin:stop])[:-1]
    return *counts, groups, owner[ends], a[final_a], b[ends - len(a)]


def align(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """A row per document: row, doc_id, the counts, the digest of its groups, and ``pairs``: its distinct linked pairs of ids, id of A << 48 | id of B << 32 | links.

    Both vocabularies have at most 65,536 ids."""
    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.chunks(batches):
            n_a, n_b, n_groups, groups, text, a, b = aligned(part.column("text").to_pylist(), folder)
            pair = a << 16 | b
            order = np.lexsort((pair, text))
            text, pair = text[order], pair[order]
            new = np.ones(len(pair), bool)
            new[1:] = (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])
            at = np.flatnonzero(new)
            links = pa.array(pair[at] << 32 | np.diff(np.append(at, len(pair))))
            offsets = np.searchsorted(text[at], np.arange(part.num_rows + 1)).astype(np.int32)
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(n_groups),
                 pa.array(digests), pa.ListArray.from_arrays(pa.array(offsets), links)],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"])
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(each, DESCRIBED)


def counted_links(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """``align`` with n_best (links whose pair is the most frequent one of its id of B, corpus-wide) and count_sum (of all links' counts)."""
    rows = settle(align(docs, folder))
    links = rows.select("row", F.explode("pairs").alias("link")).select(
        "row", F.shiftrightunsigned("link", 32).alias("pair"), F.col("link").bitwiseAND(F.lit((1 << 32) - 1)).alias("times"))
    counts = links.groupBy("pair").agg(F.sum("times").alias("count"))
    b = F.col("pair").bitwiseAND(F.lit((1 << 16) - 1))
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    judged = settle(counts.withColumn("b", b).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best")))
    total = judged.agg(F.sum("count")).first()[0] or 0
    heavy = judged.where(F.col("count") * HEAVY >= total)
    known = links.join(F.broadcast(heavy), "pair", "left")
    light = known.where("count IS NULL").select("row", "pair", "times").join(judged, "pair")

    def sums(found: DataFrame) -> DataFrame:
        return found.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                        F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    both = sums(known.where("count IS NOT NULL")).union(sums(light)).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.join(both.withColumnRenamed("row", "linked_row"), F.col("row") == F.col("linked_row"), "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
