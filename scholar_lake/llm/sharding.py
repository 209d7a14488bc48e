"""Sharding by histogram sort: exact bytes below candidate boundaries, refined until the splitters fit, then one exchange.

Only built-in functions. A document's key is 32 bits of its text's hash followed by 32 bits of its id's hash, so equal texts lie side by
side and stay in one shard, unless a splitter has to cut a group too large for that. Each round counts the bytes of 2**12 equal key ranges
inside every range that still holds a splitter (partial sums in each task; at most shards * 4,096 rows reach the driver, however many
documents there are) and ends once the bytes below each boundary are within the tolerance.

Law ``bytes``: the shards' sizes are near equal. Defined results: null text has no bytes and size 1; a null id is an id of its own;
rows equal in id and text share a key and stay together; an empty table gives an empty table; computed columns replace input columns
of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BITS, STEP = 64, 12
LOWEST, BEYOND = -2 ** 63, 2 ** 63


def shard_key() -> Column:
    text = F.shiftleft(F.shiftright(F.xxhash64(F.coalesce(F.col("text"), F.lit(""))), 32), 32)
    return text.bitwiseOR(F.xxhash64(F.col("doc_id")).bitwiseAND(F.lit(0xFFFFFFFF)))


def document_size() -> Column:
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")


def splitters(keyed: DataFrame, shards: int, tolerance: float = 0.002) -> list[int]:
    """The first keys of shards 1 to shards-1, from ``shard_key`` and ``size``; each within tolerance * (bytes of a shard) of its place.

    A boundary is only off by more where rows with the very same key leave no other place for it.
    """
    found: dict[int, int] = {}
    open_ranges: dict[int, tuple[int, list[int]]] = {}  # prefix of a key range: bytes below it, the splitters within
    bits, total = BITS, 0
    while bits and (bits == BITS or open_ranges):
        step = min(STEP, bits)
        rows = keyed
        if bits < BITS:
            rows = rows.where(F.shiftright("shard_key", bits).isin(sorted(open_ranges)))
        counted = sorted(tuple(r) for r in rows.groupBy(F.shiftright("shard_key", bits - step).alias("bin"))
                         .agg(F.sum("size").alias("bytes")).collect())
        if bits == BITS:
            total = sum(size for _, size in counted)
            if not total:
                return [BEYOND] * (shards - 1)
            open_ranges = {0: (0, list(range(1, shards)))}
        slack, refined = tolerance * total / shards, {}
        for prefix, (below, wanted) in open_ranges.items():
            bins = counted if bits == BITS else [b for b in counted if b[0] >> step == prefix]
            edges, at = [], below
            for number, size in bins:
                edges.append((number, at, at + size))
                at += size
            for j in wanted:
                goal = total * j / shards
                number, start, end = next((e for e in edges if e[2] >= goal), edges[-1])
                miss, edge = min((abs(goal - start), number), (abs(end - goal), number + 1))
                if miss <= slack or bits == step:
                    found[j] = edge << (bits - step)
                else:
                    refined.setdefault(number, (start, []))[1].append(j)
        open_ranges, bits = refined, bits - step
    return [found[j] for j in range(1, shards)]


def shard_of(key: Column, firsts: list[int]) -> Column:
    """The number of splitters at or below the key."""
    at = F.lit(0)
    for first in firsts:
        if first < BEYOND:
            at = at + (F.lit(True) if first <= LOWEST else key >= F.lit(first)).cast("int")
    return at


def shard_documents(docs: DataFrame, shards: int = 8, tolerance: float = 0.002, bins: int = 4096) -> DataFrame:
    """docs with ``size``, ``shard`` and ``slot`` (gapless from 0 in each shard).

    The rows of a shard are numbered bin by bin, so that no task sorts a whole shard: ``bins`` hash bins per shard are counted, and the
    bins' first slots (at most shards * bins rows, a bounded table) go to the tasks that number the rows. The rows move once, by (shard, bin).
    """
    keyed = docs.withColumn("size", document_size()).withColumn("shard_key", shard_key())
    firsts = splitters(keyed.select("shard_key", "size"), shards, tolerance)
    placed = (keyed.withColumn("shard", shard_of(F.col("shard_key"), firsts))
              .withColumn("shard_bin", F.pmod(F.xxhash64("shard_key"), F.lit(bins))))
    counts = placed.groupBy("shard", "shard_bin").agg(F.count(F.lit(1)).alias("bin_rows"))
    before = Window.partitionBy("shard").orderBy("shard_bin").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "shard_bin", F.coalesce(F.sum("bin_rows").over(before), F.lit(0)).alias("shard_first"))
    inside = F.row_number().over(Window.partitionBy("shard", "shard_bin").orderBy("shard_key", "doc_id", "size"))
    numbered = placed.withColumn("shard_inside", inside).join(F.broadcast(first), ["shard", "shard_bin"])
    numbered = numbered.withColumn("slot", (F.col("shard_first") + F.col("shard_inside") - 1).cast("long"))
    kept = [c for c in docs.columns if c.lower() not in ("size", "shard", "slot", "shard_key", "shard_bin")]
    return numbered.select(*[F.col(f"`{c}`") for c in kept], "size", "shard", "slot")
