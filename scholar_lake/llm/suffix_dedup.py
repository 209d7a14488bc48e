"""Suffix-array dedup: every byte covered by a string of ``length`` bytes that also starts elsewhere is removed, in whole texts.

Not all suffixes travel, but enough to decide about all of them. Of the starts in a window of length - core + 1 bytes, the one whose next 8 bytes have the
smallest hash is the window's anchor, so equal strings of ``length`` bytes have their anchor at the same place, and every such
string contains the ``core`` bytes behind its anchor. An anchor's strings together make up its segment.

1. The suffixes at all anchors are range-partitioned by their leading bytes, core and segment (splitters sampled by Spark; the document is the last
   sort column, so that one frequent suffix is spread over many buckets). Each bucket is sorted, runs of equal cores and segments are
   found by comparing neighbours, and runs that touch the end of a bucket are summed across buckets, of which there are two per bucket.
   Suffixes whose core stands alone can be dropped. Where a whole segment stands elsewhere, all of its strings do.
2. What is left are edges of copies: equal cores, different segments. One representative per different segment is cut into groups of STEPS[0] strings,
   by their distance to the anchor, and the groups go through the same sort and comparison with the bytes that all of a group's strings
   share as core. The groups left by that are cut into single strings, and those decide.

Suffixes are compared by their first 8 bytes and 64-bit hashes of the rest, not by carrying hundreds of bytes each. The local sort is Spark's
sort on several key columns, which can spill, in place of a multikey quicksort in memory.

Defined results: null and empty texts have no bytes; matches never cross documents; equal rows are copies of each other; null ids are
allowed; an empty table gives an empty table; only doc_id and text are looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from scholar_lake.llm import arrays
from scholar_lake.llm.common import document_key, settle

SPREAD = np.uint64(0x9E3779B97F4A7C15)
ODD = 0xD1342543DE82EF95  # 5 modulo 8
INVERSE = pow(ODD, -1, 2 ** 64)
_byte_values = arrays.mixed(np.arange(256))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    if len(_powers.get(base, ())) < n:
        made = np.full(max(n, 1 << 20), base, np.uint64)
        made[0] = 1
        _powers[base] = np.multiply.accumulate(made)
    return _powers[base][:n]


class RollingHash:
    """64-bit hashes of any substrings of one byte array, from running sums."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_byte_values[data] * powers(ODD, len(data)), out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        back = powers(INVERSE, len(self.sums))
        return arrays.mixed((self.sums[stop] - self.sums[start]) * back[start])


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """At each place the next 8 bytes as a number that sorts as they do (zeros behind the end)."""
    long = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray((len(data),), ">u8", buffer=long, strides=(1,)).astype(np.uint64)


def as_long(numbers: np.ndarray) -> np.ndarray:
    return numbers.view(np.int64)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each place the place of the smallest of the next ``width`` 32-bit values, the first of equal ones; len(values) - width + 1 of them."""
    best = (values.astype(np.uint64) << np.uint64(32)) | np.arange(len(values), dtype=np.uint64)
    reach = 1
    while 2 * reach <= width:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    rest = width - reach
    if rest:
        best = np.minimum(best[:len(best) - rest], best[rest:])
    return (best & np.uint64(0xFFFFFFFF)).astype(np.int64)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, core: int) -> tuple[np.ndarray, ...]:
    """(text, anchor, first string, last string) by text, in order; places in data."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    noise = ((eight_bytes(data) ^ (eight_bytes(data) >> np.uint64(29))) * SPREAD) >> np.uint64(32)
    at = sliding_argmin(noise, length - core + 1)[:len(data) - length + 1]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(at)]
    inside = np.arange(len(at)) + length <= offsets[1:][text]
    string = np.flatnonzero(inside)
    text, at = text[string], at[string]
    new = np.concatenate(([True], (np.diff(text) != 0) | (np.diff(at) != 0)))[:len(string)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(string))[:len(first)] - 1
    return text[first], at[first], string[first], string[last]


#: Strings per group, step by step.
STEPS = (16, 1)
ROW = ["lead", "core", "segment", "key", "place"]
ROW_DDL = ", ".join(f"{n} bigint" for n in ROW)
#: place: first string << 26 | anchor - first string << 14 | last - first string << 2 | asked for << 1 | second of a pair
FIRST, ANCHOR, LAST, FIELD = 26, 14, 2, (1 << 12) - 1


def pack_place(first, last, anchor, asked, twin=0):
    return first << FIRST | (anchor - first) << ANCHOR | (last - first) << LAST | asked << 1 | twin


def suffix_rows(data: np.ndarray, hashes: RollingHash, core: tuple, strings: tuple, keys: np.ndarray, places: np.ndarray,
                length: int) -> pa.RecordBatch:
    """Rows of ROW for (start, stop) of cores and (first, last, anchor) of their strings, as places in data."""
    first, last, anchor = strings
    segment = hashes.of(first, last + length) ^ arrays.mixed((anchor - first) * 2 ** 20 + last - first)
    lead = eight_bytes(data)[core[0]] ^ np.uint64(1 << 63)
    return pa.RecordBatch.from_arrays([pa.array(as_long(c)) for c in (lead, hashes.of(*core), segment)]
                                      + [pa.array(keys), pa.array(places)], names=ROW)


def suffixes(docs: DataFrame, length: int, core: int) -> DataFrame:
    """A row per anchor."""
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.chunks(batches, "dedup_text"):
            data, offsets = arrays.flat(part.column("dedup_text"))
            text, anchor, first, last = anchors(data, offsets, length, core)
            begin = offsets[:-1][text]
            yield suffix_rows(data, RollingHash(data), (anchor, anchor + core), (first, last, anchor), part.column("key").to_numpy()[text],
                              pack_place(first - begin, last - begin, anchor - begin, 1), length)
    return docs.select("key", F.col("text").alias("dedup_text")).mapInArrow(cut, ROW_DDL)


def groups(first: np.ndarray, last: np.ndarray, anchor: np.ndarray, asked: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Edges cut into groups of strings whose distances to the anchor lie in the same multiple of size: first, last, anchor, asked, multiple."""
    many = last - first + 1
    edge = np.repeat(np.arange(len(first)), many)
    start = np.arange(len(edge)) - np.repeat(np.cumsum(many) - many, many) + first[edge]
    multiple = (anchor[edge] - start) // size
    at = np.flatnonzero(np.concatenate(([True], (np.diff(edge) != 0) | (np.diff(multiple) != 0))))
    end = np.append(at[1:], len(edge)) - 1
    return start[at], start[end], anchor[edge[at]], asked[edge[at]], multiple[at]


def runs(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For sorted columns, the number of the run of equal rows that each row is in, and the runs' lengths."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new) - 1, np.diff(np.append(np.flatnonzero(new), n))


def compared(rows: DataFrame) -> DataFrame:
    """Sorted buckets of suffix rows, neighbours compared: the rows whose core has company, with

    ``same``: rows with this segment, ``others``: whether the core has another segment, ``chosen``: whether the row stands for its segment.
    """
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(list(batches), pa.schema([(c, pa.int64()) for c in ROW]))
        if not whole.num_rows:
            return
        c = {n: whole.column(n).to_numpy() for n in ROW}
        core_run, core_size = runs([c["lead"], c["core"]])
        segment_run, segment_size = runs([c["lead"], c["core"], c["segment"]])
        core_open = (core_run == 0) | (core_run == core_run[-1])
        segment_open = (segment_run == 0) | (segment_run == segment_run[-1])
        chosen = np.concatenate(([True], segment_run[1:] != segment_run[:-1]))
        kinds = np.bincount(core_run, weights=chosen)
        kept = core_open | (core_size[core_run] > 1)
        flags = {"same": segment_size[segment_run], "others": kinds[core_run] > 1, "chosen": chosen, "core_open": core_open,
                 "segment_open": segment_open}
        yield pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (*c.values(), *flags.values())], names=[*ROW, *flags])
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = rows.repartitionByRange(parts, *ROW[:4]).sortWithinPartitions(*ROW)
    found = buckets.mapInArrow(scan, ROW_DDL + ", same bigint, others boolean, chosen boolean, core_open boolean, segment_open boolean")
    # the sampled bounds of the buckets hold for this one evaluation only, so what is derived from them must come from one written result
    found = settle(found)
    core, segment = ["lead", "core"], ["lead", "core", "segment"]
    across = found.where("core_open").groupBy(*core).agg(F.count(F.lit(1)).alias("core_rows"),
                                                         (F.min("segment") != F.max("segment")).alias("core_others"))
    same_across = found.where("segment_open").groupBy(*segment).agg(F.count(F.lit(1)).alias("segment_rows"))
    # at most two cores and two segments per bucket are open
    joined = found.join(F.broadcast(across), core, "left").join(F.broadcast(same_across), segment, "left")
    whole = joined.select(*ROW, F.when(F.col("segment_open"), F.col("segment_rows")).otherwise(F.col("same")).alias("same"),
                          F.when(F.col("core_open"), F.col("core_others")).otherwise(F.col("others")).alias("others"), "chosen",
                          F.coalesce("core_rows", F.lit(2)).alias("core_rows"))
    first = F.shiftright("place", FIRST)
    last, anchor = (first + F.shiftright("place", at).bitwiseAND(F.lit(FIELD)) for at in (LAST, ANCHOR))
    return whole.where("core_rows > 1").select(
        "key", first.alias("first"), last.alias("last"), anchor.alias("anchor"), (F.col("place").bitwiseAND(F.lit(2)) > 0).alias("asked"),
        "same", "others", "chosen")


def expanded(texts: DataFrame, met: DataFrame, length: int, size: int) -> DataFrame:
    """Suffix rows of the groups of strings that the edges among the compared rows are cut into.

    A representative that is not asked for is one of several: it is written twice.
    """
    edge = F.struct("first", "last", "anchor", (F.col("asked") & (F.col("same") == 1)).alias("asked"))
    edges = (met.where("others AND (chosen OR asked AND same = 1)").groupBy(F.col("key").alias("edge_key"))
             .agg(F.collect_list(edge).alias("edges")))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for packed, key, edges in zip(batch.column("packed"), batch.column("key").to_numpy(), batch.column("edges")):
                data = np.frombuffer(unpack(packed.as_buffer()), np.uint8)
                fields = [edges.values.field(n).to_numpy(zero_copy_only=False) for n in ("first", "last", "anchor", "asked")]
                first, last, anchor, asked, multiple = groups(*fields, size)
                again = np.concatenate((np.arange(len(first)), np.flatnonzero(~asked)))
                twin = np.arange(len(again)) >= len(first)
                first, last, anchor, asked, multiple = (x[again] for x in (first, last, anchor, asked, multiple))
                inner = anchor - size * multiple
                yield suffix_rows(data, RollingHash(data), (inner, inner - size + 1 + length), (first, last, anchor), np.full(len(first), key),
                                  pack_place(first, last, anchor, asked.astype(np.int64), twin), length)
    return texts.join(edges, F.col("key") == F.col("edge_key")).mapInArrow(cut, ROW_DDL)


def duplicate_spans(keyed: DataFrame, texts: DataFrame, length: int, core: int) -> DataFrame:
    """A row per key (documents of one key have the same text): spans, an array of (start, stop) in bytes that cover what is to be removed.

    ``texts`` is used in each step with all its columns, so that its exchange by key is made once.
    """
    if not 8 <= core <= length or length - core > FIELD:
        raise ValueError("a core has 8 bytes at least and is shorter than the string by 4,095 at most")
    met = compared(suffixes(keyed.select("key", "text").where(F.octet_length("text") >= length), length, core))
    steps = [met]
    for size in STEPS:
        steps.append(compared(expanded(texts, steps[-1], length, size)))
    spans = [step.where("asked AND same > 1").select("key", F.struct(F.col("first").alias("start"), (F.col("last") + length).alias("stop")).alias("span"))
             for step in steps]
    every = reduce(DataFrame.unionByName, spans)
    return every.groupBy(F.col("key").alias("span_key")).agg(F.collect_set("span").alias("spans"))


def packed_texts(keyed: DataFrame) -> DataFrame:
    """doc_id, key and the compressed text: texts move between machines at well under their size."""
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
            packed = pa.array([press(t.as_buffer()) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), packed], names=["doc_id", "key", "packed"])
    wanted = keyed.select("doc_id", "key", "text")
    return wanted.mapInArrow(pack, wanted.drop("text").schema.add("packed", "binary"))


def remove_duplicates(docs: DataFrame, length: int = 400, core: int = 200) -> DataFrame:
    """A row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and ``kept`` (the bytes that stay)."""
    keyed = docs.select("doc_id", document_key().alias("key"), "text")
    texts = packed_texts(keyed)
    spans = duplicate_spans(keyed, texts, length, core)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for packed, found in zip(batch.column("packed"), batch.column("spans")):
                data = np.frombuffer(unpack(packed.as_buffer()), np.uint8)
                gone = np.zeros(len(data), bool)
                if found.is_valid and len(found.values):
                    start, stop = (found.values.field(n).to_numpy() for n in ("start", "stop"))
                    gone = arrays.covered(start, stop - start, len(data))
                kept = data[~gone].tobytes()
                spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + bool(len(gone) and gone[0])
                rows.append((len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    joined = texts.join(spans, F.col("key") == F.col("span_key"), "left")
    return joined.mapInArrow(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
