"""Helpers that several operators share."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word: a run of characters that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64 bits for a document. Rows with the same id and text share a key, and share every result that follows from the text."""
    return F.xxhash64(F.col(doc_id).cast("string"), F.coalesce(F.length(text), F.lit(-1)), F.col(text))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's folder for intermediate data, ``spark.checkpoint.dir``.

    Where that is unset, a local session (tests) gets a temporary folder; a cluster gets an error, as its executors would not see
    each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="checkpoints-")


#: Spark's switch (4.1) for removing a frame's shuffle files when it has run; it counts when the frame is made.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame) -> DataFrame:
    """Write df into the shared checkpoint folder and go on from there. The shuffle files that led to it are not needed any more and go at once,
    not when the driver next happens to collect its garbage."""
    context, conf = df.sparkSession.sparkContext, df.sparkSession.conf
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    before = conf.get(REMOVE_SHUFFLES, "false")
    conf.set(REMOVE_SHUFFLES, "true")
    try:
        return df.select("*").checkpoint()
    finally:
        conf.set(REMOVE_SHUFFLES, before)
