"""Merge lists: ``<root>/data/merged_ids/<entity>s/YYYY-MM-DD.csv.gz`` with ``merge_date,id,merge_into_id``."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from scholar_lake.sources.snapshot import EPOCH

MERGE_DDL = "merge_date string, id string, merge_into_id string"


def present_ids(ids: DataFrame, column: str = "id") -> DataFrame:
    """Distinct non-null ids."""
    return ids.select(F.col(column).alias("id")).where(F.col("id").isNotNull()).distinct()


def read_merged_ids(spark: SparkSession, root: str, entity: str, since: str = EPOCH,
                    files: list[str] | None = None) -> DataFrame:
    """Ids that were merged into another record, from lists whose file name is newer than ``since``.

    ``files`` names the lists to read, as ``_metadata.file_path`` spells them.
    """
    path = f"{root.rstrip('/')}/data/merged_ids/{entity}s"
    if files == []:
        return spark.createDataFrame([], "id string")
    try:
        rows = spark.read.schema(MERGE_DDL).option("header", True).option("pathGlobFilter", "*.csv.gz").csv(
            [unquote(f) for f in files] if files else path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "id string")
    return present_ids(rows.where(F.col("_metadata.file_name") > F.lit(f"{since}.csv.gz")))


def list_merge_files(spark: SparkSession, root: str, entity: str, since: str = EPOCH) -> DataFrame:
    """Pending merge lists: ``entity, file_path``."""
    path = f"{root.rstrip('/')}/data/merged_ids/{entity}s"
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv.gz").load(path).select(
            F.col("_metadata.file_path").alias("file_path"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "file_path string")
    newer = F.regexp_extract("file_path", r"([^/]+)$", 1) > F.lit(f"{since}.csv.gz")
    return files.where(newer).select(F.lit(entity).alias("entity"), "file_path")
