"""Counts of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def partition_metrics(rows: DataFrame, label: str = "partition_label", abstract: str = "abstract") -> DataFrame:
    """Records, and records with a usable abstract, per input partition."""
    return rows.groupBy(label).agg(F.count("*").alias("n_works"), F.count(abstract).alias("n_abstracts"))


def unprocessed(files: DataFrame, manifest: DataFrame, on: list[str], override: bool = False) -> DataFrame:
    """Input files that no earlier run finished; all of them with ``override``."""
    return files if override else files.join(manifest.select(*on).distinct(), on, "left_anti")
