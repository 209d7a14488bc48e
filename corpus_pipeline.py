"""The corpus pipeline: language ID, near-dedup, benchmark decontamination, mixing and sharding, over whole tables.

Each stage gets (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. ``run`` writes each stage's
result as Parquet below the cluster's shared checkpoint folder and reads it again as the next one's documents.

Defined results are those of the operators; an empty table passes through every stage. Rows with equal doc_ids are judged one by one;
of a group of near copies the row with the smallest id stays (of rows equal in id and text, the first by the other columns).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from scholar_lake.llm import decontam, mixing, ppm, sharding, simhash
from scholar_lake.llm.common import document_key, shared_folder, table

#: Documents whose language is less sure than this are rejected, as are texts that are null or have no letter,
#: and those that take more bits per byte than ``ppm.limits`` allows in their language.
LEAST_SCORE = 0.5
#: Near copies: fingerprints of word shingles of this length that differ in so many bits at most.
SHINGLE, RADIUS = 3, 3
SHARDS = 8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled documents teach."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    samples = ppm.sample(docs.where(~ppm.held_out(F.col("doc_id"))))
    judged = ppm.predict(docs.select("text", row), ppm.Model.learn(samples), "row", "text")
    sure = (F.col("lang_pred") != ppm.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return judged.where(sure & ppm.readable(ppm.limits(samples))).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    keyed = docs.select("doc_id", document_key().alias("doc_key"), "text")
    found = simhash.near_duplicates(keyed, SHINGLE, RADIUS, carry=("doc_id", "doc_key"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc_key"))
    staying = found.groupBy("component").agg(first.alias("first")).select(F.col("first.doc_key").alias("staying_key"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    kept = docs.select(document_key().alias("dedup_key"), row).join(staying, F.col("dedup_key") == F.col("staying_key"), "left_semi")
    one = Window.partitionBy("dedup_key").orderBy("row")
    return kept.withColumn("dedup_rank", F.row_number().over(one)).where("dedup_rank = 1").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item in them."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in shards of near equal bytes, with size, shard and slot."""
    return sharding.shard_documents(docs, SHARDS)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mix_sources),
          ("sharding", shard)]
#: SQL has neither the language model nor the alignment; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
