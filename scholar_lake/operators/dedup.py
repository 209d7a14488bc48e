"""At most one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_wins(versions: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in the given order.

    Spark limits each key to one row inside every map task before the shuffle (WindowGroupLimit), so a key with very many
    versions sends one row per task, not its whole history.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    return versions.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def unique_links(links: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """One row per key of a link table: the one with the greatest remaining columns, so runs agree.

    Aggregated on the map side before the shuffle. Without a key every row is its own.
    """
    rest = [c for c in links.columns if c not in key]
    if not key:
        return links
    if not rest:
        return links.distinct()
    if len(rest) == 1:
        return links.groupBy(*key).agg(F.max(rest[0]).alias(rest[0])).select(*links.columns)
    best = links.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_best"))
    return best.select(*[F.col(c) if c in key else F.col(f"_best.{c}").alias(c) for c in links.columns])
