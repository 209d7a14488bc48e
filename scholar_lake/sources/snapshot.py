"""Entity files: ``<root>/data/<entity>s/updated_date=YYYY-MM-DD/*.gz``, one JSON object per line.

The folder date and a record's own ``updated_date`` field share a name. Spark's partition discovery would let the
folder win and lose the record's time stamp, so files are found recursively and the folder date is taken from the
file path. A filter on that path is a filter on a constant of each file: Spark drops whole files by it while planning.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scholar_lake.functions.ids import partition_label
from scholar_lake.schemas import record_ddl

CORRUPT = "_corrupt_record"
EPOCH = "1970-01-01"
_READ = {"recursiveFileLookup": "true", "pathGlobFilter": "*.gz"}


def entity_path(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/data/{entity}s"


def folder_name(file_path: Column) -> Column:
    return F.regexp_extract(file_path, r"([^/]+)/[^/]+$", 1)


def newer_folder(file_path: Column, since: str) -> Column:
    """Strictly newer than the watermark, comparing folder names as text (ISO dates sort that way)."""
    return folder_name(file_path) > F.lit(f"updated_date={since}")


def read_entity(spark: SparkSession, root: str, entity: str, since: str = EPOCH,
                only: tuple[str, ...] | None = None, provenance: bool = False,
                files: list[str] | None = None) -> DataFrame:
    """Records of an entity in partitions newer than ``since``; a narrower read with ``only``.

    With ``provenance`` the raw text of records that do not fit the schema is kept in ``_corrupt_record``, and
    ``file_path``, ``partition_date`` and ``partition_label`` say where a record came from. ``files`` names the files to
    read, as ``_metadata.file_path`` spells them; choosing them here and not by a join keeps the records where they are, however many files
    there are. Gzip files cannot be split, so a file is one task; what follows (staging to Parquet) is a plain map over them.
    """
    ddl = record_ddl(entity, only) + (f", `{CORRUPT}` string" if provenance else "")
    reader = spark.read.options(**_READ).schema(ddl)
    if provenance:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    try:
        records = reader.json([unquote(f) for f in files] if files else entity_path(root, entity))
        if files == []:
            records = records.limit(0)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        records = spark.createDataFrame([], f"{ddl}, _metadata struct<file_path:string>")
    path = F.col("_metadata.file_path")
    columns = [F.col(f"`{c}`") for c in records.columns if c != "_metadata"]
    newer = records.where(newer_folder(path, since))
    if not provenance:
        return newer.select(*columns)
    return newer.select(
        *columns, path.alias("file_path"), F.regexp_replace(folder_name(path), "^updated_date=", "").alias("partition_date"),
        partition_label(path).alias("partition_label"))


def list_files(spark: SparkSession, root: str, entity: str, since: str = EPOCH) -> DataFrame:
    """The pending files of an entity: ``entity, file_path, length``. Only the listing is read, never the content."""
    try:
        files = spark.read.format("binaryFile").options(**_READ).load(entity_path(root, entity)).select(
            "length", F.col("_metadata.file_path").alias("file_path"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "file_path string, length long")
    return files.where(newer_folder(F.col("file_path"), since)).select(
        F.lit(entity).alias("entity"), "file_path", "length")


def pending_counts(files: DataFrame, merge_files: DataFrame | None = None) -> DataFrame:
    """Files waiting per entity: ``entity, partitions`` and, with merge files given, ``merge_files``."""
    counts = files.groupBy("entity").agg(F.count_distinct("file_path").alias("partitions"))
    if merge_files is None:
        return counts
    merges = merge_files.groupBy("entity").agg(F.count_distinct("file_path").alias("merge_files"))
    return counts.join(merges, "entity", "full").na.fill(0, ["partitions", "merge_files"])
