"""Lookups and joins over the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from scholar_lake.operators.skew import skew_join


def by_id(table: DataFrame, *ids: str) -> DataFrame:
    """Records by id."""
    return table.where(F.col("id").isin(*ids))


def by_doi(works: DataFrame, *dois: str) -> DataFrame:
    """Works by DOI; on the stored table Parquet's bloom filter on ``id_doi`` skips row groups."""
    return works.where(F.col("id_doi").isin(*dois))


def by_year(works: DataFrame, first: int, last: int | None = None) -> DataFrame:
    """Works published in a year, or in a range of years."""
    return works.where(F.col("publication_year").between(first, first if last is None else last))


def select_works(works: DataFrame, **values) -> DataFrame:
    """Works whose typed fields have the given values; a pair is an inclusive range, a list is any of its values."""
    for field, value in values.items():
        column = F.col(field)
        if isinstance(value, tuple):
            works = works.where(column.between(*value))
        elif isinstance(value, list):
            works = works.where(column.isin(*value))
        else:
            works = works.where(column == F.lit(value))
    return works


def authors_of_works(works: DataFrame, authorships: DataFrame, authors: DataFrame) -> DataFrame:
    """``work_id, title, exact_position, author_id, display_name``: every authorship whose work and author are known.

    The author side is where a few authors may hold many rows, so their authorships are salted.
    """
    links = authorships.select("work_id", "author_id", "exact_position").where(F.col("author_id").isNotNull())
    named = skew_join(links, authors.select(F.col("id").alias("author_id"), "display_name"), "author_id")
    return named.join(works.select(F.col("id").alias("work_id"), "title"), "work_id")


def works_of_author(works: DataFrame, authorships: DataFrame, author_id: str) -> DataFrame:
    """Works of one author."""
    mine = authorships.where(F.col("author_id") == author_id).select(F.col("work_id").alias("id")).distinct()
    return works.join(mine, "id", "left_semi")


def citation_counts(references: DataFrame) -> DataFrame:
    """``id, n_citing``: distinct works citing each work. (work_a_id, work_b_id) is unique, so rows are counted."""
    return references.groupBy(F.col("work_b_id").alias("id")).agg(F.count("*").alias("n_citing"))


def neighbours(edges: DataFrame, node: str, source: str, target: str) -> DataFrame:
    """``id, direction``: nodes one edge away, outgoing and incoming."""
    out = edges.where(F.col(source) == node).select(F.col(target).alias("id"), F.lit("out").alias("direction"))
    into = edges.where(F.col(target) == node).select(F.col(source).alias("id"), F.lit("in").alias("direction"))
    return out.unionByName(into)


def closure(edges: DataFrame, source: str, target: str, folder: str, most_depth: int | None = None) -> DataFrame:
    """``id, reached, depth``: all nodes that each node leads to, with the least number of edges; a node on a cycle reaches itself.

    Breadth first: a level joins the pairs found last with the edges and drops pairs known before, so every pair is followed once and cycles end. Each
    level is written below ``folder`` (shared by all machines) and read again, so plans stay small and a lost executor costs one level. Chains of length n
    take n levels; null ends lead nowhere.
    """
    spark = edges.sparkSession
    known = edges.where(F.col(source).isNotNull() & F.col(target).isNotNull())
    steps = known.select(F.col(source).alias("at"), F.col(target).alias("next"))
    found = known.select(F.col(source).alias("id"), F.col(target).alias("reached")).distinct()
    depth, paths = 1, []
    while True:
        paths.append(f"{folder.rstrip('/')}/depth-{depth}")
        found.withColumn("depth", F.lit(depth)).write.parquet(paths[-1])
        latest = spark.read.parquet(paths[-1])
        if depth == most_depth or latest.isEmpty():
            return spark.read.parquet(*paths)
        onward = latest.join(steps, F.col("reached") == F.col("at")).select("id", F.col("next").alias("reached")).distinct()
        found = onward.join(spark.read.parquet(*paths).select("id", "reached"), ["id", "reached"], "left_anti")
        depth += 1


def register_views(read: Callable[[str], DataFrame], names: list[str], prefix: str = "") -> None:
    """Make the tables available to ``spark.sql`` under their names."""
    for name in names:
        read(name).createOrReplaceTempView(prefix + name)
