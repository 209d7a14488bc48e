"""MinHash near-dedup: banded candidates, estimated by odd sketches, confirmed on full sets of shingles.

A node is a distinct set of shingles. Its signature has BANDS x ROWS minima of hash functions; nodes that agree in all rows of a band share a bucket. Of two sets at the
limit of 0.85 the chance to share none of the 40 buckets is 6e-9. The signature's samples (number of the function, minimum) are folded into an odd sketch, a bitmap
of parities: samples that two sketches have in common cancel out in their XOR, so its population count tells how many differ, most precisely where few do. A pair passes within SIGMAS
standard deviations of what the limit lets expect. A second bitmap holds the parities of the whole set; its XOR never has more bits than
the sets differ in, which rules out pairs without error. What is left is confirmed by the exact sizes of intersection and union.

Buckets are dealt by ranges of (band, key, node), so that a large one is spread over many tasks, and read twice:

1. In each task a bucket's nodes are compared with its centre, the node nearest to the majority of the sketches, and what is not similar to that with the next centre, up to
   CENTRES times. Confirmed links give the first components; a group of copies of one text is one star.
2. Buckets with more than one component are open. The nodes outside their largest component are compared with all other nodes of the bucket, which are dealt over as
   many tasks as the bucket has blocks of BLOCK nodes. For each node, the few nearest nodes of other components are confirmed. Nodes of which candidates were held
   back are compared again, in these buckets only, until none is held back, so no candidate is left out.

Defined results: a text of fewer words than a shingle is one shingle; null and blank texts have an empty set and are linked with nothing, not even each other; rows with
equal texts are one node; null ids are documents too, and a component's id is its smallest id that is not null; an empty table gives an empty table; only doc_id and text are looked
at. Shingles are told apart by 64-bit hashes. A text is processed whole, at about 60 bytes of memory per byte.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from scholar_lake.llm import arrays
from scholar_lake.llm.common import document_key, settle
from scholar_lake.llm.simhash import components

WORDS = 3
LIMIT = Fraction(85, 100)
BANDS, ROWS = 40, 6
SAMPLES = BANDS * ROWS
#: Bits of the odd sketch of the samples and of the parities of the whole set.
SKETCH_BITS, PARITY_BITS = 512, 1024
SIGMAS = 6
CENTRES, BLOCK, NEAREST = 4, 4096, 4
#: Pairs whose ends are broadcast: 8 MB of numbers at most.
FEW = 1 << 19
_factors = arrays.mixed(np.arange(1, SAMPLES + 1)) | np.uint64(1)
_shifts = arrays.mixed(np.arange(SAMPLES + 1, 2 * SAMPLES + 1))
DESCRIBED = "doc_id bigint, doc_key bigint, node bigint, n_shingles bigint, bands array<bigint>, sketch binary"


def most_bits(limit: Fraction = LIMIT) -> int:
    """Bits in which the odd sketches of two sets at the limit may differ.

    Of the samples a share of 1 - limit differs, give or take; each that does puts two samples into the XOR, and n samples set SKETCH_BITS / 2 * (1 - exp(-2 n / SKETCH_BITS)) bits.
    """
    differ = float(1 - limit)
    samples = 2 * (SAMPLES * differ + SIGMAS * (SAMPLES * differ * (1 - differ)) ** 0.5)
    bits = SKETCH_BITS / 2 * (1 - np.exp(-2 * samples / SKETCH_BITS))
    return int(bits + SIGMAS * (bits * (1 - bits / SKETCH_BITS)) ** 0.5 / 2)


MOST_BITS = most_bits()


def parities(places: np.ndarray, owner: np.ndarray, rows: int, bits: int) -> np.ndarray:
    """A bitmap per row: bit i is 1 if i occurs an odd number of times among the row's places."""
    odd = np.bincount(owner * bits + places, minlength=rows * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(rows, bits), axis=1)


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of each text's shingles, and where each text's begin (n + 1 numbers)."""
    data, offsets = arrays.flat(column)
    lower = arrays.LOWER[data]
    starts, stops, first = arrays.pieces(lower, offsets, arrays.SPACES)
    words, count = arrays.piece_hashes(lower, starts, stops), np.diff(first)
    text = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(words)) - first[:-1][text]
    hashes = np.zeros(len(words), np.uint64)
    for i in range(WORDS):  # a short text is one shingle: what its words leave free counts as nothing
        there = np.flatnonzero(place + i < count[text])
        hashes[there] = arrays.mixed(hashes[there] + words[there + i])
    own = np.flatnonzero((place + WORDS <= count[text]) | (place == 0))
    text, hashes = text[own], hashes[own]
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], np.searchsorted(text[new], np.arange(len(count) + 1))


def signatures(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each set (none is empty) the minimum under each hash function."""
    out = np.empty((len(begin), SAMPLES), np.uint64)
    for i in range(SAMPLES):
        out[:, i] = np.minimum.reduceat((hashes ^ _shifts[i]) * _factors[i], begin)
    return out


def described(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, node (null for an empty set), n_shingles, bands, and both bitmaps in ``sketch``."""
    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.chunks(batches, "minhash_text"):
            hashes, begin = shingle_sets(part.column("minhash_text"))
            sizes = np.diff(begin)
            full = np.flatnonzero(sizes)
            raw = hashes.tobytes()
            nodes = np.zeros(len(sizes), np.uint64)
            for i in full.tolist():
                nodes[i] = xxhash.xxh64_intdigest(raw[8 * begin[i]:8 * begin[i + 1]])
            bands, sketches = [None] * len(sizes), [None] * len(sizes)
            if len(full):
                minima = signatures(hashes, begin[full])
                keys = np.zeros((len(full), BANDS), np.uint64)
                for i in range(ROWS):
                    keys = arrays.mixed(keys + minima[:, i::ROWS])
                owner = np.repeat(np.arange(len(full)), SAMPLES)
                spread = (arrays.mixed((minima + _factors).ravel()) % np.uint64(SKETCH_BITS)).astype(np.int64)
                whole = (arrays.mixed(hashes) % np.uint64(PARITY_BITS)).astype(np.int64)
                both = np.concatenate((parities(spread, owner, len(full), SKETCH_BITS),
                                       parities(whole, np.repeat(np.arange(len(full)), sizes[full]), len(full), PARITY_BITS)), axis=1)
                for i, k, s in zip(full.tolist(), keys.view(np.int64), both):
                    bands[i], sketches[i] = k, s.tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("doc_key"), pa.array(nodes.view(np.int64), mask=sizes == 0), pa.array(sizes), pa.array(bands, pa.list_(pa.int64())),
                 pa.array(sketches, pa.binary())], names=["doc_id", "doc_key", "node", "n_shingles", "bands", "sketch"])
    return docs.select("doc_id", document_key().alias("doc_key"), F.col("text").alias("minhash_text")).mapInArrow(each, DESCRIBED)


def bitmaps(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Odd sketches and parities of whole sets, as rows of 64-bit numbers."""
    width = (SKETCH_BITS + PARITY_BITS) // 64
    rows = np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, width)
    return rows[:, :SKETCH_BITS // 64], rows[:, SKETCH_BITS // 64:]


def apart(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ others).sum(axis=1, dtype=np.int64)


def similar(sketch, parity, size, sketches, parities_, sizes) -> tuple[np.ndarray, np.ndarray]:
    """Which of the others may reach the limit with one node, and in how many bits their odd sketches differ from its."""
    low, high = LIMIT.numerator, LIMIT.denominator
    bits = apart(sketch, sketches)
    good = np.flatnonzero((bits <= MOST_BITS) & (np.minimum(size, sizes) * high >= low * np.maximum(size, sizes)))
    # |A xor B| is at most (1 - limit) / (1 + limit) of |A| + |B|
    exact = apart(parity, parities_[good]) * (high + low) <= (high - low) * (size + sizes[good])
    return good[exact], bits


def busy_rows(nodes: DataFrame) -> DataFrame:
    """(band, key, node) of the buckets with company; of buckets at the ends of a task all rows."""
    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, known = ("band", "key", "node"), None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(c).to_numpy() for c in names]
            if held is not None:
                rows = [np.concatenate((h, r)) for h, r in zip(held, rows)]
            same = (rows[0][1:] == rows[0][:-1]) & (rows[1][1:] == rows[1][:-1])
            company = np.zeros(len(rows[0]), bool)
            company[1:] |= same
            company[:-1] |= same
            company[0] |= known
            known = bool(len(same) and same[-1])  # the last row waits for the next batch, which may bring more of its bucket
            held = [r[-1:] for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(r[:-1][company[:-1]]) for r in rows], names=names)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(h) for h in held], names=names)
    dealt = nodes.select("node", F.posexplode("bands").alias("band", "key")).select("band", "key", "node")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartitionByRange(parts, "band", "key", "node").sortWithinPartitions("band", "key", "node").mapInArrow(
        each, "band int, key bigint, node bigint")


def bucket_parts(batches: Iterable[pa.RecordBatch], by: tuple[str, ...], most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows that agree in ``by``, at most ``most`` rows each (0: whole)."""
    waiting: list[pa.RecordBatch] = []
    last, held = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in by]
        change = np.flatnonzero(np.logical_or.reduce([np.diff(k) != 0 for k in keys])) + 1
        for i, j in zip([0, *change], [*change, batch.num_rows]):
            own = tuple(k[i] for k in keys)
            if waiting and (own != last or most and held + j - i > most):
                yield pa.Table.from_batches(waiting).combine_chunks()
                waiting, held = [], 0
            last = own
            waiting.append(batch.slice(i, j - i))
            held += j - i
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks()


def stars(buckets: DataFrame) -> DataFrame:
    """Candidate links (a, b) of the nodes of a bucket's part with the centres that they are similar to."""
    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bucket_parts(batches, ("band", "key"), BLOCK):
            node, size = part.column("node").to_numpy(), part.column("n_shingles").to_numpy()
            sketches, whole = bitmaps(part.column("sketch"))
            left = np.arange(len(node))
            for _ in range(CENTRES):
                if len(left) < 2:
                    break
                ones = np.unpackbits(sketches[left].view(np.uint8).reshape(len(left), -1), axis=1).sum(axis=0)
                majority = np.packbits(2 * ones > len(left)).view(np.uint64)
                centre = left[int(np.argmin(apart(majority, sketches[left])))]
                near = left[similar(sketches[centre], whole[centre], size[centre], sketches[left], whole[left], size[left])[0]]
                others = near[near != centre]
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(node[others], node[centre])), pa.array(np.minimum(node[others], node[centre]))],
                                                 names=["a", "b"])
                left = np.setdiff1d(left, np.append(near, centre), assume_unique=True)
    parts = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = buckets.repartitionByRange(parts, "band", "key", "node").sortWithinPartitions("band", "key", "node")
    return dealt.mapInArrow(each, "a bigint, b bigint").distinct()


def open_buckets(labelled: DataFrame) -> DataFrame:
    """Buckets of more than one component: band, key, their largest component ``main`` and the number of ``blocks`` they are dealt over."""
    sizes = labelled.groupBy("band", "key", "label").agg(F.count(F.lit(1)).alias("n"))
    buckets = sizes.groupBy("band", "key").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("labels"))
    return buckets.where("labels > 1").select("band", "key", F.col("top.label").alias("main"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))


def across(members: DataFrame, nearest: int) -> DataFrame:
    """Candidate links (a, b) between components of open buckets, up to ``nearest`` for each node that is ``asked``; a row with a = b, band and key where more were
    held back.

    A block has its own part of the bucket's nodes, and all nodes that are asked. Of two that are, the greater one is.
    """
    all_blocks = F.sequence(F.lit(0), F.col("blocks") - 1)
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = members.select("*", own.alias("own_block"), F.explode(F.when(F.col("asked"), all_blocks).otherwise(F.array(own))).alias("block"))

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in bucket_parts(batches, ("band", "key", "block"), 0):
            c = {n: part.column(n).to_numpy(zero_copy_only=False) for n in ("node", "n_shingles", "label", "asked", "own_block", "block")}
            sketches, whole = bitmaps(part.column("sketch"))
            mine = np.flatnonzero(c["own_block"] == c["block"])
            found_a, found_b, held = [], [], []
            for i in np.flatnonzero(c["asked"]).tolist():
                others = mine[c["label"][mine] != c["label"][i]]
                others = others[~c["asked"][others] | (c["node"][others] < c["node"][i])]
                near, bits = similar(sketches[i], whole[i], c["n_shingles"][i], sketches[others], whole[others], c["n_shingles"][others])
                if len(near) > nearest:
                    near = near[np.argsort(bits[near], kind="stable")[:nearest]]
                    held.append(i)
                partner = c["node"][others[near]]
                found_a.append(np.maximum(partner, c["node"][i]))
                found_b.append(np.minimum(partner, c["node"][i]))
            if found_a:
                a, b = (np.concatenate((*found, c["node"][held])) for found in (found_a, found_b))
                known = np.arange(len(a)) < len(a) - len(held)  # a link may be found in many buckets and needs none
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), part.column("band")[0].as_py(), np.int32), mask=known),
                                                  pa.array(np.full(len(a), part.column("key")[0].as_py(), np.int64), mask=known)], names=["a", "b", "band", "key"])
    wanted = dealt.select("band", "key", "block", "own_block", "node", "n_shingles", "label", "asked", "sketch")
    keys = ("band", "key", "block")
    return wanted.repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(each, "a bigint, b bigint, band int, key bigint").distinct()


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``member`` and ``grams`` of the wanted nodes, from one text each."""
    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.chunks(batches, "text"):
            hashes, begin = shingle_sets(part.column("text"))
            grams = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("member"), grams], names=["member", "grams"])
    texts = docs.select(document_key().alias("text_key"), "text")
    one = nodes.select(F.col("node").alias("member"), "doc_key")
    return texts.join(one, F.col("text_key") == F.col("doc_key")).select("member", "text").mapInArrow(each, "member bigint, grams array<bigint>").dropDuplicates(["member"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that reach the limit on their full sets. The pairs are counted first and should be written already."""
    low, high = LIMIT.numerator, LIMIT.denominator
    if pairs.count() <= FEW:  # far fewer than there are sets: the others need not travel
        ends = pairs.select(F.explode(F.array("a", "b")).alias("end")).distinct()
        sets = sets.join(F.broadcast(ends), F.col("member") == F.col("end"), "left_semi")
    a, b = sets.toDF("a", "x"), sets.toDF("b", "y")
    shared = F.size(F.array_intersect("x", "y"))
    both = pairs.join(a, "a").join(b, "b").withColumn("shared", shared)
    return both.where(high * F.col("shared") >= low * (F.size("x") + F.size("y") - F.col("shared"))).select("a", "b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id (the smallest doc_id of its component) and kept (whether it is that document)."""
    rows = settle(described(docs))
    nodes = settle(rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.min("doc_key").alias("doc_key"), *[F.any_value(c).alias(c) for c in ("n_shingles", "bands", "sketch")]))
    members = settle(busy_rows(nodes).join(nodes.select("node", "n_shingles", "sketch"), "node"))
    sets = settle(full_sets(docs, nodes.join(members.select("node").distinct(), "node", "left_semi")))
    roots = settle(components(confirmed(settle(stars(members)), sets)))
    places, sketched = members.select("band", "key", "node"), nodes.select("node", "n_shingles", "sketch")
    nearest, held = NEAREST, None
    while True:
        labels = roots.select(F.col("node").alias("leaf"), "root")
        if held is not None:  # in all other buckets, every candidate has been looked at
            places = members.select("band", "key", "node").join(held.select("band", "key").distinct(), ["band", "key"], "left_semi")
        labelled = places.join(labels, F.col("node") == F.col("leaf"), "left").withColumn("label", F.coalesce("root", "node")).drop("leaf", "root")
        opened = labelled.join(open_buckets(labelled), ["band", "key"])
        if held is None:
            asked = opened.withColumn("asked", F.col("label") != F.col("main"))
        else:
            asked = opened.join(held.withColumn("again", F.lit(True)), ["band", "key", "node"], "left").withColumn("asked", F.col("again").isNotNull()).drop("again")
        candidates = settle(across(asked.join(sketched, "node"), nearest))
        new = settle(confirmed(candidates.where("a <> b").select("a", "b"), sets))
        held = candidates.where("a = b").select("band", "key", F.col("a").alias("node")).distinct()
        held_back = not held.isEmpty()
        if not new.isEmpty():
            roots = settle(components(new.union(roots.select("node", "root"))))
        elif held_back:
            nearest *= 16
        if not held_back:
            break
    rooted = nodes.join(roots.select(F.col("node").alias("leaf"), "root"), F.col("node") == F.col("leaf"), "left").select(
        "node", "least", F.coalesce("root", "node").alias("component"))
    named = rooted.groupBy("component").agg(F.min("least").alias("component_least"))
    classes = rooted.join(named, "component").select(F.col("node").alias("class"), "component_least")
    return rows.join(classes, F.col("node") == F.col("class"), "left").select(
        "doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_least")).alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
