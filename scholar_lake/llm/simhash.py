"""SimHash near-dedup with covering locality-sensitive hashing.

A fingerprint has 64 bits; each is the majority of that bit over the XXH64 hashes of the text's features: its word shingles, repeats
included, or its distinct shingles. Covering masks (see ``covering_masks``) give 2**(radius+1) - 1 tables; two fingerprints that differ
in at most ``radius`` bits agree under at least one of the masks, so no pair is missed.

Distinct fingerprints go to one bucket per table. Inside a bucket the links are found exactly and only a spanning star of each linked set
is emitted; a bucket of more than DIRECT fingerprints is first split on radius + 1 blocks of the bits on which it may differ (one block
must agree), again and again, so that no large bucket is compared pair by pair. Components come from alternating large-star and
small-star rounds on DataFrames. Neither links nor labels reach the driver; lineage is cut with checkpoints.

Defined results: texts without a word (and null) have fingerprint 0 and are linked like any other; equal rows give equal rows; null ids
are documents too, and a component's id is its smallest id that is not null; an empty table gives an empty table; only doc_id and text are looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from scholar_lake.llm.common import settle
from scholar_lake.operators.skew import heavy_keys

SEED = 42
DIRECT = 1024
SLAB = 1 << 15
MOST_LINKS = 1 << 20


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = SEED, distinct: bool = False) -> int:
    """Majority bits of the hashes of all word shingles; 0 without words. Fewer words than a shingle are one shingle."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    count = max(len(words) - shingle + 1, 1)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    parts = map(joined.__getitem__, map(slice, (ends - lengths)[:count].tolist(), ends[min(shingle, len(words)) - 1:].tolist()))
    features = list(set(parts)) if distinct else list(parts)
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(features), SLAB):
        hashes = np.array([digest(f, seed) for f in features[i:i + SLAB]], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(features), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seeds: tuple[int, ...] = (SEED,), distinct: bool = False,
                 carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns and ``prints``, one fingerprint per seed as signed 64-bit numbers."""
    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("simhash_text").cast(pa.large_binary())
            prints = []
            for t in texts:
                raw = t.as_buffer().to_pybytes() if t.is_valid else None
                prints.append([fingerprint(raw, shingle, seed, distinct) for seed in seeds])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], pa.array(prints, pa.list_(pa.int64()))],
                                             names=[*carry, "prints"])
    wanted = docs.select(*carry, F.col("text").alias("simhash_text"))
    return wanted.mapInArrow(each, wanted.select(*carry).schema.add("prints", T.ArrayType(T.LongType())))


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """One mask per nonzero vector v of radius + 1 bits: the positions whose own vector has an odd product with v.

    Positions take the nonzero vectors in turn. For at most ``radius`` positions there is a nonzero v with an even product with all of their
    vectors (fewer equations than unknowns), and its mask leaves those positions out.
    """
    size = 2 ** (radius + 1)
    return [sum(1 << i for i in range(bits) if bin((i % (size - 1) + 1) & v).count("1") % 2) for v in range(1, size)]


def signed(mask: int) -> int:
    return mask - 2 ** 64 if mask >= 2 ** 63 else mask


def close(prints: np.ndarray, radius: int) -> np.ndarray:
    """For each of a few fingerprints the place of the first one that it is linked with, directly or through others."""
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
    labels = np.arange(len(prints))
    while True:
        least = np.where(near, labels[None, :], len(prints)).min(axis=1)
        least = np.minimum(least, least[least])
        if np.array_equal(least, labels):
            return labels
        labels = least


def distinct_links(prints: np.ndarray, places: np.ndarray, free: list[int], radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links, as pairs of places, that span what is linked among distinct fingerprints that differ only in the free bits."""
    if len(prints) < 2:
        return []
    if len(free) <= radius:
        return [(places[1:], np.full(len(prints) - 1, places[0]))]
    if len(prints) <= DIRECT:
        labels = close(prints, radius)
        other = labels != np.arange(len(prints))
        return [(places[other], places[labels[other]])]
    found = []
    for block in np.array_split(np.array(free), radius + 1):
        key = prints & np.bitwise_or.reduce(np.uint64(1) << block.astype(np.uint64))
        order = np.argsort(key, kind="stable")
        rest = [b for b in free if b not in set(block.tolist())]
        edges = np.flatnonzero(np.diff(key[order])) + 1
        for group in np.split(order, edges):
            found += distinct_links(prints[group], places[group], rest, radius)
    return found


def bucket_links(prints: np.ndarray, free: list[int], radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same for fingerprints that may be equal, which are linked to the first of their kind."""
    kinds, first, which = np.unique(prints, return_index=True, return_inverse=True)
    places = np.arange(len(prints))
    copies = first[which] != places
    return [(places[copies], first[which][copies]), *distinct_links(kinds, first, free, radius)]


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets that the links connect, each as links from its nodes to its smallest one."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = ends[:len(a)], ends[len(a):]
    labels = np.arange(len(nodes))
    while True:
        least = np.minimum(labels[a], labels[b])
        lower = labels.copy()
        np.minimum.at(lower, a, least)
        np.minimum.at(lower, b, least)
        lower = lower[lower]
        if np.array_equal(lower, labels):
            other = labels != np.arange(len(nodes))
            return nodes[other], nodes[labels[other]]
        labels = lower


def free_bits(mask: int) -> list[int]:
    """The bits on which fingerprints of one bucket may differ."""
    return [b for b in range(64) if not mask >> b & 1]


def split_heavy(dealt: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """Rows of buckets (t, key, fp, node), where buckets that are a large share of all rows are replaced by radius + 1 sets of smaller ones.

    Each set takes one block of the free bits into the key. Fingerprints that differ in at most radius free bits agree on one of the blocks, so each link
    is still inside some bucket.
    """
    blocks = [[sum(1 << int(b) for b in block) for block in np.array_split(np.array(free_bits(m)), radius + 1)] for m in masks]
    heavy = F.broadcast(heavy_keys(dealt.select(F.xxhash64("t", "key").alias("bucket")), "bucket"))
    block = F.get(F.get(F.lit([[signed(b) for b in row] for row in blocks]), F.pmod("t", F.lit(len(masks)))), F.col("part"))
    parts = F.when(F.col("heavy_key").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.lit(radius)))
    split = dealt.join(heavy, F.xxhash64("t", "key") == F.col("heavy_key"), "left").select("t", "key", "fp", "node", F.explode(parts).alias("part"))
    finer = F.xxhash64("key", "part", F.col("fp").bitwiseAND(block))
    return split.select("t", F.when(F.col("part") < 0, F.col("key")).otherwise(finer).alias("key"), "fp", "node")


def links(nodes: DataFrame, radius: int = 3, seeds: int = 1) -> DataFrame:
    """Distinct (a, b) with a > b of nodes (``node``, ``prints``), which span all sets linked by ``radius`` or fewer differing bits
    between two fingerprints of one seed."""
    masks = covering_masks(radius)
    tables = F.array(*[F.struct(F.lit(s * len(masks) + i).alias("t"), F.get("prints", F.lit(s)).alias("fp"),
                                F.get("prints", F.lit(s)).bitwiseAND(F.lit(signed(m))).alias("key"))
                       for s in range(seeds) for i, m in enumerate(masks)])
    dealt = nodes.select("node", F.explode(tables).alias("bucket")).select("bucket.t", "bucket.key", "bucket.fp", "node")
    dealt = split_heavy(dealt, masks, radius)
    free = [free_bits(m) for m in masks]

    def whole_buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        """Runs of whole buckets; a bucket that goes on in the next batch waits for its end."""
        waiting: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = tuple(batch.column(c).to_numpy() for c in ("t", "key", "fp", "node"))
            t, key = rows[:2]
            change = np.flatnonzero((np.diff(t) != 0) | (np.diff(key) != 0)) + 1
            if waiting and (waiting[-1][0][-1], waiting[-1][1][-1]) != (t[0], key[0]):
                change = np.concatenate(([0], change))
            if len(change):
                waiting.append(tuple(r[:change[-1]] for r in rows))
                yield tuple(np.concatenate(c) for c in zip(*waiting))
                waiting = []
                rows = tuple(r[change[-1]:] for r in rows)
            waiting.append(rows)
        if waiting:
            yield tuple(np.concatenate(c) for c in zip(*waiting))

    def linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's buckets have many links in common; it passes on one star for each set that they connect."""
        own, room, made = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], MOST_LINKS, 0
        for found in in_buckets(batches):
            own.append(found)
            made += len(found[0])
            if made > room:
                own = [stars(*(np.concatenate(x) for x in zip(*own)))]
                made, room = len(own[0][0]), MOST_LINKS + 2 * len(own[0][0])
        a, b = stars(*(np.concatenate(x) for x in zip(*own)))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def in_buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for t, key, fp, node in whole_buckets(batches):
            if not len(t):
                continue
            fp = fp.view(np.uint64)
            edge = np.flatnonzero(np.concatenate(([True], (np.diff(t) != 0) | (np.diff(key) != 0), [True])))
            first, size = edge[:-1], np.diff(edge)
            twos = first[size == 2]
            near = twos[np.bitwise_count(fp[twos] ^ fp[twos + 1]) <= radius]
            found = [(node[near], node[near + 1])]
            for i, n in zip(first[size > 2], size[size > 2]):
                own = node[i:i + n]
                found += [(own[a], own[b]) for a, b in bucket_links(fp[i:i + n], free[t[i] % len(masks)], radius)]
            yield tuple(np.concatenate(x) for x in zip(*found))
    return dealt.repartition("t", "key").sortWithinPartitions("t", "key").mapInArrow(linked, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node with an edge that is not a root."""
    edges = settle(edges.where("a <> b"))
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = down.join(lowest, F.col("a") == F.col("u")).select("b", F.col("m").alias("m"), "a")
        pairs = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        edges = settle(pairs.where("a <> b").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, seeds: tuple[int, ...] = (SEED,), distinct: bool = False,
                    carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A row per document: the carried columns (doc_id among them), prints, ``component`` (a number of its set of linked documents) and
    component_id, the smallest doc_id in it. Documents are linked if their fingerprints of any one seed are."""
    made = fingerprints(docs, shingle, seeds, distinct, carry)
    node = F.get("prints", F.lit(0)) if len(seeds) == 1 else F.xxhash64("prints")
    prints = settle(made.withColumn("node", node))
    nodes = prints.groupBy("node").agg(F.min("doc_id").alias("least"), F.any_value("prints").alias("prints"))
    roots = components(links(nodes.select("node", "prints"), radius, len(seeds))).withColumnRenamed("node", "leaf")
    rooted = nodes.join(roots, F.col("node") == F.col("leaf"), "left").select("node", "least", F.coalesce("root", "node").alias("component"))
    named = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "component").select(F.col("node").alias("class"), "component", "component_id")
    return prints.join(classes, F.col("node") == F.col("class")).select(*carry, "prints", "component", "component_id")
