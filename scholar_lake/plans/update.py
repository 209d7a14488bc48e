"""One update run: new partitions of the snapshot into the lake.

Per entity: parse each new file once into staged Parquet, set bad records aside, keep the newest version of each id, flatten
into all tables, and exchange the touched buckets. The commit comes last and covers every table.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scholar_lake.config import Settings
from scholar_lake.functions.abstracts import abstract_text
from scholar_lake.functions.ids import strip_id
from scholar_lake.operators.dedup import latest_wins
from scholar_lake.operators.flatten import flatten
from scholar_lake.operators.metrics import partition_metrics, unprocessed
from scholar_lake.operators.search import search_documents
from scholar_lake.operators.skew import heavy_keys, skew_join
from scholar_lake.schemas import ENTITIES, SEARCH_TABLE, TABLES, TableSpec, tables_of
from scholar_lake.sinks.tables import LakeTables
from scholar_lake.sources.merged_ids import list_merge_files, read_merged_ids
from scholar_lake.sources.snapshot import EPOCH, list_files, read_entity
from scholar_lake.sources.validation import REASON, SEARCH_REASON, mark, split, with_wrong_types


TABLES_AT_A_TIME = 4


@dataclass
class UpdateReport:
    """What a run did, per entity: the date it started from, the newest date it read, records and rejects; and for entities with more files
    than one part takes, the date up to which they have been read."""

    commit: int
    runs: list[str]
    since: dict[str, str] = field(default_factory=dict)
    watermark: dict[str, str] = field(default_factory=dict)
    metrics: dict[str, dict[str, int]] = field(default_factory=dict)
    left: dict[str, str] = field(default_factory=dict)

    @property
    def run(self) -> str:
        return self.runs[-1]

    def add(self, later: "UpdateReport") -> None:
        """Take in the report of the next part of the same run."""
        self.commit, self.left = later.commit, later.left
        self.runs += later.runs
        self.watermark |= later.watermark
        for entity, counts in later.metrics.items():
            own = self.metrics.setdefault(entity, dict.fromkeys(counts, 0))
            self.metrics[entity] = {name: own[name] + n for name, n in counts.items()}


def run_update(spark: SparkSession, settings: Settings, tables: bool = True, search: bool = True,
               apply_deletes: bool = True, override: bool = False,
               entities: tuple[str, ...] = ENTITIES, files_at_a_time: int = 10_000) -> UpdateReport:
    """Bring the lake up to date. ``override`` also reads files that an earlier run has finished.

    Progress is kept per entity and per target, tables or search, and apart for merge lists, so that skipping one of them now
    does not skip these files for it later. The two targets accept different records.

    File names pass through the driver, so a run takes whole dates of at most ``files_at_a_time`` files of an entity (one date at least),
    oldest first, and commits them before the next. Merge lists are applied with the first part, so what is delivered later stays.
    """
    report = run_part(spark, settings, tables, search, apply_deletes, override, {entity: settings.since for entity in entities}, files_at_a_time)
    while report.left:
        report.add(run_part(spark, settings, tables, search, False, override, report.left, files_at_a_time))
    return report


def run_part(spark: SparkSession, settings: Settings, tables: bool, search: bool, apply_deletes: bool, override: bool,
             start: dict[str, str | None], files_at_a_time: int) -> UpdateReport:
    """One part of a run. ``start`` names the entities and the date each is read from, if not from its watermark."""
    lake = LakeTables(spark, settings.out, settings.buckets)
    marks = lake.watermarks()
    number = lake.next_commit()
    report = UpdateReport(number, [lake.run])
    written: dict[str, dict[int, bool]] = {}
    new_marks: dict[str, str] = {}
    read_files: list[DataFrame] = []

    for entity, date in start.items():
        targets = ([f"{entity} tables"] if tables else []) + ([f"{entity} search"] if search and entity == "work" else [])
        if not targets:
            continue
        since = date or min(marks.get(target, EPOCH) for target in targets)
        merge_targets = merge_progress(targets) if apply_deletes else []
        report.since[entity] = since
        stage = f"{settings.out}/staging/{lake.run}/{entity}"
        files = staged_files(list_files(spark, settings.root, entity, since), lake, targets, f"{stage}/files", override)
        files, until = first_dates(files, files_at_a_time)
        if until:
            report.left[entity] = until
        merges = pending_merges(spark, settings, lake, entity, merge_targets, f"{stage}/merge_files", override)
        if files.isEmpty() and merges.isEmpty():
            report.metrics[entity] = {"records": 0, "rejects": 0}
            continue
        deleted = read_merged_ids(spark, settings.root, entity, EPOCH, paths(merges))
        report.metrics[entity], staged = stage_records(
            read_entity(spark, settings.root, entity, since, provenance=True, files=paths(files)),
            entity, f"{stage}/records", REASON if tables else SEARCH_REASON)
        set_aside(staged, entity, [REASON] * tables + [SEARCH_REASON] * (f"{entity} search" in targets),
                  f"{settings.out}/quarantine/{number}/{entity}")
        if tables:
            records = newest_records(split(staged)[0], f"{stage}/newest")
            written.update(exchange(lake, tables_of(entity), flatten(records, entity), record_ids(records), deleted))
        if f"{entity} search" in targets:
            records = newest_records(split(staged, SEARCH_REASON)[0], f"{stage}/newest_search")
            written.update(exchange(lake, [SEARCH_TABLE], {SEARCH_TABLE.name: search_documents(records)}, record_ids(records), deleted))

        newest = files.agg(F.max("partition_date")).first()[0]
        if newest:
            report.watermark[entity] = newest
            new_marks.update(dict.fromkeys([*targets, *merge_targets], newest))
        read_files += [for_targets(files, targets), *([for_targets(merges, merge_targets)] if merge_targets else [])]

    if read_files:
        lake.commit(number, written, reduce(DataFrame.unionByName, read_files), new_marks)
    return report


def first_dates(files: DataFrame, most: int) -> tuple[DataFrame, str | None]:
    """The files of the oldest dates, at most so many but one date at least; and the last of these dates if files are left."""
    dates = sorted(tuple(row) for row in files.groupBy("partition_date").agg(F.count("*")).collect())
    total, until = 0, None
    for date, n in dates:
        if until is not None and total + n > most:
            return files.where(F.col("partition_date") <= until), until
        total, until = total + n, date
    return files, None


def merge_progress(targets: list[str]) -> list[str]:
    """Names under which the merge lists applied to the targets are kept."""
    return [f"{target} merges" for target in targets]


def pending_merges(spark: SparkSession, settings: Settings, lake: LakeTables, entity: str, merge_targets: list[str], path: str,
                   override: bool = False) -> DataFrame:
    """Merge lists not yet applied to all of the targets. Lists up to the date that an applying run has read are done with; those that came
    while deletes were not applied are not."""
    marks = lake.watermarks()
    since = settings.since or min((marks.get(target, EPOCH) for target in merge_targets), default=EPOCH)
    found = list_merge_files(spark, settings.root, entity, since)
    return staged_files(found if merge_targets else found.limit(0), lake, merge_targets, path, override)


def for_targets(files: DataFrame, targets: list[str]) -> DataFrame:
    return files.select(F.explode(F.array(*[F.lit(t) for t in targets])).alias("target"), "file_path")


def set_aside(staged: DataFrame, entity: str, reasons: list[str], path: str) -> None:
    """Write the records that any of the targets rejects, with the reasons and the paths of wrong types."""
    rejected = reduce(Column.__or__, [F.col(reason) != "" for reason in reasons], F.lit(False))
    bad = staged.where(rejected)
    if not bad.isEmpty():
        with_wrong_types(bad, entity).write.mode("overwrite").parquet(path)


def staged_files(files: DataFrame, lake: LakeTables, targets: list[str], path: str, override: bool) -> DataFrame:
    """The files this run reads, written down first, so that one that arrives meanwhile waits for the next run.

    One row per file.
    """
    pending = unprocessed(files, lake.processed(targets), ["file_path"], override)
    pending.select("file_path", F.nullif(
        F.regexp_extract("file_path", r"updated_date=([^/]+)/[^/]+$", 1), F.lit("")).alias("partition_date")
    ).write.mode("overwrite").parquet(path)
    return lake.spark.read.schema("file_path string, partition_date string").parquet(path)


def paths(files: DataFrame) -> list[str]:
    """File names, which the driver holds for any scan of these files."""
    return [row["file_path"] for row in files.select("file_path").toLocalIterator()]


def record_ids(records: DataFrame) -> DataFrame:
    return records.select(strip_id(F.col("id")).alias("id"))


def stage_records(records: DataFrame, entity: str, path: str, reason: str = REASON) -> tuple[dict[str, int], DataFrame]:
    """Parse, mark and write records; gives the counts by the rules of one target and the staged rows.

    One pass over the JSON for all tables. The marks need the whole record, so no column is pruned from the parse; the counts
    read one staged column.
    """
    marked = mark(records, entity)
    marked.write.mode("overwrite").parquet(path)
    staged = records.sparkSession.read.schema(marked.schema).parquet(path)
    counts = staged.agg(F.count("*").alias("records"), F.count(F.when(F.col(reason) != "", 1)).alias("rejects")).first()
    return counts.asDict(), staged


def newest_records(good: DataFrame, path: str) -> DataFrame:
    """The newest version of each record, so that children also come from that version only.

    Ids that occur more than once are found on the id column alone. Usually there are none and the staged records are used as
    they are; otherwise only the repeated ones are sorted and shuffled whole.
    """
    repeated = record_ids(good).groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("id")
    if repeated.isEmpty():
        return good
    keyed = good.withColumn("_key", strip_id(F.col("id")))
    twice = repeated.withColumnRenamed("id", "_key")
    heavy = heavy_keys(keyed, "_key")
    newest = latest_wins(
        skew_join(keyed, twice, "_key", "left_semi", heavy), ["_key"],
        [F.col("updated_date").try_cast("timestamp_ntz").desc_nulls_last(), F.desc("partition_date"),
         F.desc("file_path"), F.desc(F.xxhash64(F.to_json(F.struct(*[c for c in good.columns]))))])
    kept = skew_join(keyed, twice, "_key", "left_anti", heavy).unionByName(newest).drop("_key")
    kept.write.mode("overwrite").parquet(path)
    return good.sparkSession.read.schema(kept.schema).parquet(path)


def exchange(lake: LakeTables, specs: list[TableSpec], new_tables: dict[str, DataFrame],
             changed: DataFrame, deleted: DataFrame | None = None) -> dict[str, dict[int, bool]]:
    """Replace the changed records' rows in every table, touching only the buckets of changed or deleted ids."""
    if not specs:
        return {}
    gone = changed if deleted is None else changed.unionByName(deleted)
    buckets = lake.touched(gone)
    lake.live_paths(specs[0].name)  # load the bucket map before the threads share it

    def write(spec: TableSpec) -> dict[int, bool]:
        return lake.replace(spec, new_tables[spec.name], [changed] if deleted is None else [changed, deleted], buckets)

    # the tables do not depend on each other, so their jobs share the cluster
    with ThreadPoolExecutor(TABLES_AT_A_TIME) as pool:
        return dict(zip([spec.name for spec in specs], pool.map(write, specs)))


def partition_report(spark: SparkSession, settings: Settings, run: str) -> DataFrame:
    """Works, and works with a usable abstract, per input file of a run, from its staged records."""
    staged = spark.read.parquet(f"{settings.out}/staging/{run}/work/records").where(F.col(REASON) == "")
    return partition_metrics(staged.select(
        "partition_label", abstract_text(F.col("abstract_inverted_index")).alias("abstract")))


def register_lake(spark: SparkSession, settings: Settings) -> None:
    """Current tables as temporary views for ``spark.sql``."""
    lake = LakeTables(spark, settings.out, settings.buckets)
    for spec in [*TABLES.values(), SEARCH_TABLE]:
        lake.read(spec).createOrReplaceTempView(spec.name)
