"""Registered queries: each operator over its whole table, with the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from scholar_lake.llm import (chat, decontam, licences, minhash, mixing, ppm, ranked_search, repetition, secrets, sharding, simhash, suffix_dedup,
                              tokenizer_links)
from scholar_lake.llm.common import table


def quality(spark: SparkSession, sf: str) -> DataFrame:
    return repetition.judge(table(spark, sf, "documents"))


def secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *[secrets.counted(F.col("base_spans"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.listed(F.col("base_spans")), 256).alias("base_sha256"),
        secrets.listed(F.array_sort(F.concat("base_spans", "method_spans"))).alias("spans"),
        F.size("method_spans").cast("long").alias("n_entropy"))


def language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", ppm.held_out(F.col("doc_id")).alias("held_out"))
    return ppm.predict(docs, ppm.learn(docs.where("NOT held_out")), "doc_id", "held_out")


def mixing_plan(spark: SparkSession, sf: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, sf, "documents").select("doc_id", "text", "source"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def license_scan(spark: SparkSession, sf: str) -> DataFrame:
    scanned = licences.scan(table(spark, sf, "documents"))
    base = F.filter("places", lambda p: p["exact"])

    def labels(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda p: p["first"])).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)).alias("score"))


def suffix_copies(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_duplicates(table(spark, sf, "documents")).drop("kept")


def near_copies(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex(F.get("prints", F.lit(0))), 16, "0")).alias("fingerprint"), "component_id")


def benchmark_leaks(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def chat_format(spark: SparkSession, sf: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    chats = chat.format_chats(chat.through_records(chat.turns_of_table(rows)))
    read = chats.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"),
                        chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("learnt"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length("learnt").cast("long").alias("loss_chars"), F.sha2(F.col("learnt"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def shard_plan(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    sharded = sharding.shard_documents(docs.withColumn("text_crc32", F.crc32(F.coalesce(F.col("text"), F.lit("")))))
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))


def minhash_copies(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf, "documents"))


def token_links(spark: SparkSession, sf: str) -> DataFrame:
    return tokenizer_links.counted_links(table(spark, sf, "documents"))


def ranked_documents(spark: SparkSession, sf: str) -> DataFrame:
    return ranked_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


QUERIES = {
    "op1_repetition": quality,
    "op2_secrets": secret_scan,
    "op3_language": language,
    "op4_mixing": mixing_plan,
    "op5_licenses": license_scan,
    "op6_suffix_dedup": suffix_copies,
    "op7_simhash": near_copies,
    "op8_decontamination": benchmark_leaks,
    "op9_chat": chat_format,
    "op10_sharding": shard_plan,
    "op11_minhash": minhash_copies,
    "op12_tokenizer_links": token_links,
    "op13_ranked_search": ranked_documents,
    "pipeline": corpus_pipeline.run,
}
