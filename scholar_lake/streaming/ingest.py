"""Incremental ingest as a stream: new files are found by the checkpoint, each batch is a keyed replace."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from scholar_lake.config import Settings
from scholar_lake.functions.ids import strip_id
from scholar_lake.operators.dedup import latest_wins
from scholar_lake.operators.flatten import flatten
from scholar_lake.operators.merge import drop_stale
from scholar_lake.operators.search import search_documents
from scholar_lake.plans.update import (exchange, for_targets, merge_progress, newest_records, paths, pending_merges, record_ids, set_aside,
                                       stage_records)
from scholar_lake.schemas import SEARCH_TABLE, TableSpec, record_ddl, tables_of
from scholar_lake.sinks.tables import LakeTables
from scholar_lake.sources.snapshot import CORRUPT, entity_path, folder_name
from scholar_lake.sources.merged_ids import read_merged_ids
from scholar_lake.sources.validation import REASON, SEARCH_REASON, split


def read_entity_stream(spark: SparkSession, root: str, entity: str, files_per_batch: int = 1000) -> DataFrame:
    """Records of an entity's files, with provenance, as a stream."""
    path = F.col("_metadata.file_path")
    stream = (spark.readStream.schema(record_ddl(entity) + f", `{CORRUPT}` string")
              .option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", True)
              .option("pathGlobFilter", "*.gz").option("maxFilesPerTrigger", files_per_batch)
              .json(entity_path(root, entity)))
    return stream.select("*", path.alias("file_path"),
                         F.regexp_replace(folder_name(path), "^updated_date=", "").alias("partition_date"))


def run_to_completion(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Feed everything that is new to ``apply``, batch by batch, then stop. A batch may be delivered twice."""
    query = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def batch_label(spark: SparkSession, name: str, checkpoint: str, batch_id: int) -> str:
    """Name of a batch that no other checkpoint shares: batch numbers start again with a new one, the query's id does not."""
    query = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
    return f"{name} query {query} batch {batch_id}"


def apply_merges(spark: SparkSession, settings: Settings, entity: str, specs: list[TableSpec]) -> None:
    """Delete the ids of merge lists that neither a stream nor an update run has applied yet.

    Comes before the batches, so that a record delivered again after its merge stays, as in an update run.
    """
    lake = LakeTables(spark, settings.out, settings.buckets)
    targets = merge_progress([f"{entity} tables"] + ([f"{entity} search"] if SEARCH_TABLE in specs else []))
    merges = pending_merges(spark, settings, lake, entity, targets, f"{settings.out}/staging/{lake.run}/{entity}/merge_files")
    if merges.isEmpty():
        return
    deleted = read_merged_ids(spark, settings.root, entity, files=paths(merges))
    nothing = {spec.name: spark.createDataFrame([], spec.ddl) for spec in specs}
    lake.commit(lake.next_commit(), exchange(lake, specs, nothing, deleted), for_targets(merges, targets))


def stream_update(spark: SparkSession, settings: Settings, entity: str, files_per_batch: int = 1000) -> None:
    """Bring one entity's tables up to date from the files its checkpoint has not seen and the merge lists not yet applied."""
    lake = LakeTables(spark, settings.out, settings.buckets)
    checkpoint = f"{settings.out}/checkpoints/{entity}"
    specs = tables_of(entity) + ([SEARCH_TABLE] if entity == "work" else [])
    apply_merges(spark, settings, entity, specs)

    def not_stale(records: DataFrame, spec: TableSpec) -> DataFrame:
        # files may arrive in any order, so what the lake already has newer stays
        current = lake.read(spec, lake.touched(record_ids(records)))
        versions = records.withColumns({"_record": F.struct(*records.columns), "id": strip_id(F.col("id")),
                                        "updated_date": F.col("updated_date").try_cast("timestamp_ntz")})
        return drop_stale(versions.select("_record", "id", "updated_date"), current).select("_record.*")

    def apply(batch: DataFrame, batch_id: int) -> None:
        label = batch_label(spark, entity, checkpoint, batch_id)
        if lake.done(label):
            return
        number, stage = lake.next_commit(), f"{settings.out}/staging/{lake.run}/{entity}"
        _, staged = stage_records(batch, entity, f"{stage}/records")
        set_aside(staged, entity, [REASON] + [SEARCH_REASON] * (entity == "work"), f"{settings.out}/quarantine/{number}/{entity}")
        records = not_stale(newest_records(split(staged)[0], f"{stage}/newest"), specs[0])
        written = exchange(lake, tables_of(entity), flatten(records, entity), record_ids(records))
        if entity == "work":
            found = not_stale(newest_records(split(staged, SEARCH_REASON)[0], f"{stage}/newest_search"), SEARCH_TABLE)
            written |= exchange(lake, [SEARCH_TABLE], {SEARCH_TABLE.name: search_documents(found)}, record_ids(found))
        lake.commit(number, written, label=label)

    run_to_completion(read_entity_stream(spark, settings.root, entity, files_per_batch), apply, checkpoint)


def stream_replace(stream: DataFrame, spec: TableSpec, out: str, checkpoint: str, order: list[Column],
                   buckets: int | None = None) -> DataFrame:
    """Keep the newest row of each key of a stream in one table; returns the table when the stream has been read."""
    lake = LakeTables(stream.sparkSession, out, buckets)

    def apply(batch: DataFrame, batch_id: int) -> None:
        label = batch_label(lake.spark, spec.name, checkpoint, batch_id)
        if lake.done(label):
            return
        number = lake.next_commit()
        staged = f"{out}/staging/{lake.run}/{spec.name}"
        # one read of the batch; an older row arriving late must not win, so the stored rows compete
        batch.write.mode("overwrite").parquet(staged)
        fresh = batch.sparkSession.read.schema(batch.schema).parquet(staged)
        touched = lake.touched(fresh.select(F.col(spec.owner).cast("string").alias("id")))
        newest = latest_wins(fresh.select(*spec.columns), list(spec.key), order)
        lake.commit(number, {spec.name: lake.compete(spec, newest, order, touched)}, label=label)

    run_to_completion(stream, apply, checkpoint)
    return lake.read(spec)
