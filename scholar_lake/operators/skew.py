"""Joins on keys of which a few hold a large share of the rows, for joins that Spark does not split by itself."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import DataFrame, functions as F

#: A key is heavy from this many times a task's even share of the rows.
HEAVY_TIMES = 2
#: Counters of one sketch at most, about 2 MB; with more tasks than an eighth of it, a key is heavy from HEAVY_TIMES shares of that many tasks on.
MOST_COUNTERS = 1 << 16


def heavy_keys(rows: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """``heavy_key, salts``: keys with more than HEAVY_TIMES / tasks of the rows, and the number of tasks their share is worth.

    ``tasks`` is the number of shuffle partitions if not given. The sketches hold at most MOST_COUNTERS counters, whatever the number of tasks, so
    there are never more than MOST_COUNTERS / 16 heavy keys; a key that is too small to be found goes to one task, which changes how long that task takes and nothing else.
    One lazy pass over one column: frequent-items sketches per task, merged by square root of the number of tasks at a time, so that no merge reads them all. The
    sketch overestimates by at most a quarter of the threshold, so no heavy key is missed.
    """
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = max(min(tasks, MOST_COUNTERS // 8), 1)
    most, counters = max(shares // HEAVY_TIMES, 1), max(8 * shares, 64)
    parts = (rows.where(F.col(key).isNotNull()).groupBy(F.pmod(F.spark_partition_id(), F.lit(tasks)).alias("part"))
             .agg(F.expr(f"approx_top_k_accumulate(`{key}`, {counters})").alias("sketch"), F.count("*").alias("n")))
    merged = parts
    # grouped to the end, because no sketch at all cannot be combined
    for groups in (isqrt(tasks - 1) + 1, 1):
        merged = merged.groupBy(F.pmod("part", F.lit(groups)).alias("part")).agg(
            F.expr(f"approx_top_k_combine(sketch, {counters})").alias("sketch"), F.sum("n").alias("n"))
    items = merged.select("n", F.explode(F.expr(f"approx_top_k_estimate(sketch, {most})")).alias("top"))
    salts = F.ceil(F.col("top.count") * tasks / F.col("n")).cast("long")
    return items.where(F.col("top.count") * shares > HEAVY_TIMES * F.col("n")).select(F.col("top.item").alias("heavy_key"), salts.alias("salts"))


def skew_join(rows: DataFrame, other: DataFrame, key: str, how: str = "inner", heavy: DataFrame | None = None,
              tasks: int | None = None, parts: int = 0) -> DataFrame:
    """Join ``rows`` to ``other`` (one row per key) on ``key``; each heavy key of ``rows`` is spread over as many tasks as its share asks for.

    Only the matching rows of ``other`` are repeated, once per salt, in all at most tasks + tasks / HEAVY_TIMES; all other keys
    join as usual. The table of heavy keys is broadcast: it has at most MOST_COUNTERS / 16 rows. The salt is a hash of the row's content, so a task that is
    run again sends every row where it went before. With ``parts`` the join has that many tasks, whatever their bytes. ``how``: inner, left, left_semi or left_anti.
    """
    heavy = F.broadcast(heavy_keys(rows, key, tasks) if heavy is None else heavy)
    content = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns if c != key])
    salted = (rows.join(heavy, F.col(key) == F.col("heavy_key"), "left")
              .withColumn("_salt", F.pmod(content, F.coalesce("salts", F.lit(1).cast("long")))).drop("heavy_key", "salts"))
    spread = (other.join(heavy, F.col(key) == F.col("heavy_key"), "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1).cast("long")) - 1)))
              .drop("heavy_key", "salts"))
    if parts:
        salted, spread = (df.repartition(parts, key, "_salt") for df in (salted, spread))
    return salted.join(spread, [key, "_salt"], how).drop("_salt")
