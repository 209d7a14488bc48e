"""Language ID by prediction by partial matching: exact code lengths under frozen byte context trees.

For each language the counts of byte strings of up to ORDER + 1 bytes are learnt from a bounded sample of labelled rows (at most
``sample_docs`` texts and ``sample_bytes`` bytes per language, by hash of the id). A byte costs -log2 of its probability in its longest known context; on the way
down each context that does not know it costs its escape (method C: distinct successors over total plus distinct), and what the longer
context knew is excluded below, down to equal probability for what is left of the 256 bytes. The counts are frozen, so
every string of ORDER + 1 known bytes has its cost in a table, and the others are costed by the same walk. The language is the one
with the shortest code; the score is its posterior under equal priors.

The model is of bounded size and broadcast; texts are scored in slices of some MB, nothing is shuffled. Defined results: a text that is null or
has no letter gives ``und`` with score 0, and so does every text if nothing could be learnt; a null id counts as held out; ties go
to the first language by code point; equal rows give equal rows; an empty table gives an empty table; only doc_id, text and, for learning, lang are looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from scholar_lake.llm import arrays

ORDER = 3
UNKNOWN = "und"
SLICE_BYTES = 1 << 20
#: For ``limits``: held-out texts of sf0.1 take up to 3.3 times their language's median, texts in unlearnt languages and junk about 4 times and more.
LIMIT, SLACK = 3.5, 64


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(True))


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts, each behind ORDER line ends that stand for its beginning; and their new offsets."""
    lengths = np.diff(offsets)
    out = np.full(len(data) + ORDER * len(lengths), 10, np.uint8)
    out[np.arange(len(data)) + np.repeat(ORDER * np.arange(1, len(lengths) + 1), lengths)] = data
    return out, offsets + ORDER * np.arange(len(offsets))


def strings(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte of each text, itself and the ORDER bytes before it as a number."""
    buffer, shifted = padded(data, offsets)
    codes = np.zeros(max(len(buffer) - ORDER, 0), np.uint32)
    for i in range(ORDER + 1):
        codes = (codes << np.uint32(8)) | buffer[i:len(buffer) - ORDER + i]
    inside = np.ones(len(codes), bool)
    for i in range(ORDER):  # strings that begin in one text and end in the start mark of the next
        at = shifted[1:-1] + i - ORDER
        inside[at[at >= 0]] = False
    return codes[inside]


class ContextTree:
    """Frozen counts of one language: per context length the strings with counts, and the contexts with what a coder needs."""

    def __init__(self, codes: np.ndarray):
        self.strings, self.counts, self.contexts, self.total, self.distinct, self.excluded = [], [], [], [], [], []
        for k in range(ORDER + 1):
            known, counts = np.unique(codes & np.uint32(2 ** (8 * (k + 1)) - 1), return_counts=True)
            contexts, first = np.unique(known >> np.uint32(8), return_index=True)
            self.strings.append(known)
            self.counts.append(counts.astype(float))
            self.contexts.append(contexts)
            self.total.append(np.add.reduceat(counts, first).astype(float))
            self.distinct.append(np.diff(np.append(first, len(known))).astype(float))
            if k:  # of the next shorter context's total, the part of the bytes that this context knows
                shorter = known & np.uint32(2 ** (8 * k) - 1)
                below = self.counts[k - 1][np.searchsorted(self.strings[k - 1], shorter)]
                self.excluded.append(np.add.reduceat(below, first))
            else:
                self.excluded.append(np.zeros(len(contexts)))

    def cost(self, codes: np.ndarray) -> np.ndarray:
        """Bits that the last byte of each string takes after the others."""
        bits = np.zeros(len(codes))
        open_, gone, gone_kinds = np.arange(len(codes)), np.zeros(len(codes)), np.zeros(len(codes))
        for k in range(ORDER, -1, -1):
            code = codes[open_] & np.uint32(2 ** (8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(self.contexts[k], code >> np.uint32(8)), len(self.contexts[k]) - 1)
            met = self.contexts[k][at] == code >> np.uint32(8)
            total = np.where(met, self.total[k][at] - gone, 0)
            kinds = np.where(met, self.distinct[k][at] - gone_kinds, 0)
            spot = np.minimum(np.searchsorted(self.strings[k], code), len(self.strings[k]) - 1)
            hit = self.strings[k][spot] == code
            some = np.maximum(total + kinds, 1)
            bits[open_] += np.where(hit, -np.log2(self.counts[k][spot] / some), np.where(kinds > 0, -np.log2(np.maximum(kinds, 1) / some), 0))
            gone = np.where(met, self.excluded[k][at], 0)[~hit]
            gone_kinds = np.where(met, self.distinct[k][at], 0)[~hit]
            open_ = open_[~hit]
        bits[open_] += np.log2(256 - gone_kinds)
        return bits


@dataclass
class Model:
    """The trees, and the costs of all strings that any of them knows."""

    languages: list[str]
    trees: list[ContextTree]

    @classmethod
    def learn(cls, samples: dict[str, list[str]]) -> "Model":
        trees = {}
        for language, texts in sorted(samples.items()):
            codes = strings(*arrays.flat(pa.array(texts, pa.string())))
            if len(codes):
                trees[language] = ContextTree(codes)
        return cls(list(trees), list(trees.values()))

    def walk(self, codes: np.ndarray) -> np.ndarray:
        return np.stack([tree.cost(codes) for tree in self.trees], axis=1)

    def prepare(self) -> None:
        """Tables from the bytes before to a context, and from that and the byte to the place of the string's costs."""
        known = np.unique(np.concatenate([tree.strings[ORDER] for tree in self.trees]))
        self.costs = np.concatenate((np.zeros((1, len(self.trees))), self.walk(known)))
        used = np.unique(known.view(np.uint8))
        self.symbols = np.full(256, len(used), np.int32)
        self.symbols[used] = np.arange(len(used))
        base = len(used) + 1
        parts = [self.symbols[(known >> np.uint32(8 * i)) & np.uint32(255)].astype(np.int64) for i in range(ORDER, -1, -1)]
        context = (parts[0] * base + parts[1]) * base + parts[2]
        contexts, number = np.unique(context, return_inverse=True)
        self.context_number = np.zeros(base ** ORDER, np.int32)
        self.context_number[contexts] = np.arange(1, len(contexts) + 1)
        self.place = np.zeros((len(contexts) + 1) * base, np.int32)
        self.place[(number + 1) * base + parts[3]] = np.arange(1, len(known) + 1)
        self.base = base

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text in each language."""
        lengths = np.diff(offsets)
        out = np.zeros((len(lengths), len(self.trees)))
        full = np.flatnonzero(lengths)
        if not len(full):
            return out
        if not hasattr(self, "costs"):
            self.prepare()
        buffer, shifted = padded(data, offsets)
        s = self.symbols[buffer]
        context = (s[:-3] * np.int32(self.base) + s[1:-2]) * np.int32(self.base) + s[2:-1]
        place = np.concatenate((np.zeros(ORDER, np.int32), self.place[self.context_number[context] * np.int64(self.base) + s[3:]]))
        text_byte = np.ones(len(buffer), bool)
        text_byte[(shifted[:-1, None] + np.arange(ORDER)).ravel()] = False
        unknown = np.flatnonzero((place == 0) & text_byte)
        place = place[text_byte]
        first = offsets[:-1][full]
        for j in range(len(self.trees)):
            out[full, j] = np.add.reduceat(self.costs[:, j][place], first)
        if len(unknown):
            codes = np.zeros(len(unknown), np.uint32)
            for i in range(ORDER, -1, -1):
                codes = (codes << np.uint32(8)) | buffer[unknown - i]
            kinds, which = np.unique(codes, return_inverse=True)
            costs, owner = self.walk(kinds), np.searchsorted(shifted, unknown, "right") - 1
            for j in range(len(self.trees)):
                out[:, j] += np.bincount(owner, weights=costs[which, j], minlength=len(lengths))
        return out


def sample(rows: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample_docs: int = 600,
           sample_bytes: int = 2_000_000) -> dict[str, list[str]]:
    """A bounded sample of rows: those with the smallest hashes of each language.

    A count of each language's rows sets the share of hashes to look at, so that only about 1.5 * sample_docs rows of a language move.
    Of a text of over a tenth of sample_bytes its beginning is sampled, a fortieth as many characters (four bytes each at most).
    """
    labelled = rows.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "lang IS NOT NULL AND text IS NOT NULL").withColumn("spot", F.shiftright(F.xxhash64("doc_id"), 33) + 2 ** 30)
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return {}
    near = F.lit(False)
    for language, n in sizes.items():
        near = near | ((F.col("lang") == language) & (F.col("spot") < int(min(1.0, 1.5 * (sample_docs + 50) / n) * 2 ** 31)))
    order = Window.partitionBy("lang").orderBy("spot", "doc_id", "text")
    long = F.octet_length("text") > sample_bytes // 10
    taken = (labelled.where(near).withColumn("text", F.when(long, F.substring("text", 1, sample_bytes // 40)).otherwise(F.col("text")))
             .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= sample_docs)
             .withColumn("until", F.sum(F.octet_length("text")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
             .where(F.col("until") <= sample_bytes))
    samples: dict[str, list[str]] = {}
    for row in taken.select("lang", "text").toLocalIterator():
        samples.setdefault(row["lang"], []).append(row["text"])
    return samples


def learn(rows: DataFrame, **how) -> Model:
    """A model from such a sample."""
    return Model.learn(sample(rows, **how))


def limits(samples: dict[str, list[str]]) -> dict[str, float]:
    """The most bits per byte of a text in each language: LIMIT times the median of every second sampled text under a model of the others.

    A language of fewer than two sampled texts has no limit.
    """
    found = {}
    for language, texts in samples.items():
        taught, asked = Model.learn({language: texts[::2]}), [t for t in texts[1::2] if t]
        if taught.trees and asked:
            ends = np.cumsum([len(t.encode()) for t in asked])
            codes = strings(*arrays.flat(pa.array(asked, pa.string())))
            bits = np.add.reduceat(taught.trees[0].cost(codes), np.append(0, ends[:-1]))
            found[language] = LIMIT * float(np.median(bits / np.diff(np.append(0, ends))))
    return found


def readable(limits: dict[str, float]) -> Column:
    """Whether a predicted row's text is short enough in code for its language; SLACK bits are free, as few bytes say little."""
    most = F.coalesce(*[F.when(F.col("lang_pred") == language, F.lit(most)) for language, most in limits.items()], F.lit(float("inf")))
    return F.col("bits_per_byte") <= most + SLACK / F.greatest(F.octet_length("text"), F.lit(1))


def predict(docs: DataFrame, model: Model, *carry: str) -> DataFrame:
    """A row per document: the carried columns, ``lang_pred``, ``score`` (0 to 1) and ``bits_per_byte`` of the text in that language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*carry, F.col("text").alias("ppm_text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("ppm_letter"))

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frozen = shared.value
        names = np.array([*frozen.languages, UNKNOWN], object)
        for part in arrays.chunks(batches, "ppm_text", SLICE_BYTES):
            data, offsets = arrays.flat(part.column("ppm_text"))
            ok = np.asarray(part.column("ppm_letter").to_numpy(zero_copy_only=False), bool)
            best, score, bits = np.full(len(ok), len(names) - 1), np.zeros(len(ok)), np.zeros(len(ok))
            if frozen.languages:
                lengths = frozen.code_lengths(data, offsets)
                best = np.where(ok, lengths.argmin(axis=1), best)
                least = lengths.min(axis=1)
                score = np.where(ok, 1 / np.exp2(np.maximum(least[:, None] - lengths, -1000)).sum(axis=1), 0.0)
                bits = np.where(ok, least / np.maximum(np.diff(offsets), 1), 0.0)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in carry], pa.array(names[best], pa.string()),
                                              pa.array(score, pa.float64()), pa.array(bits, pa.float64())], names=out)
    out = [*carry, "lang_pred", "score", "bits_per_byte"]
    schema = kept.select(*carry).schema.add("lang_pred", "string").add("score", "double").add("bits_per_byte", "double")
    return kept.mapInArrow(scored, schema)
