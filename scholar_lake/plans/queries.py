"""The registered queries: every operator of the library over the driver's whole tables.

Results are plain columns: lists joined to text, time stamps as text, 32-bit numbers widened.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from scholar_lake.config import work_dir
from scholar_lake.functions.abstracts import abstract_text, blank_to_null, build_index, rebuild_abstract
from scholar_lake.functions.casting import empty_as_null, typed_load
from scholar_lake.functions.documents import apc_value, grants_json, mesh_json, title_abstract
from scholar_lake.functions.ids import partition_label, strip_id
from scholar_lake.functions.lists import array_literal, clean_list, parse_literal
from scholar_lake.functions.text import analyze_query, has_any, tokenize, tokenize_words
from scholar_lake.operators import flatten, lookups, search
from scholar_lake.operators.dedup import latest_wins
from scholar_lake.operators.merge import cascade_delete, delete_by_key, drop_stale, replace_rows
from scholar_lake.operators.metrics import partition_metrics, unprocessed
from scholar_lake.plans import nesting
from scholar_lake.plans.nesting import table, url, words
from scholar_lake.plans.update import exchange, for_targets
from scholar_lake.schemas import SEARCH_FIELDS, SEARCH_TABLE, TABLES, TableSpec, record_ddl
from scholar_lake.sinks.exports import read_csv, write_csv, write_json
from scholar_lake.sinks.tables import LakeTables
from scholar_lake.sources.merged_ids import list_merge_files, present_ids, read_merged_ids
from scholar_lake.sources.snapshot import CORRUPT, list_files, pending_counts, read_entity
from scholar_lake.sources.validation import mark, not_null_split, with_wrong_types
from scholar_lake.streaming.ingest import stream_replace as run_stream_replace

SINCE = "2024-01-15"
#: Rows of a table of numbers that one task makes nested records from, or compares with deleted ids.
ROWS_PER_TASK = 1 << 18


def plain(df: DataFrame, as_text: tuple[str, ...] = ()) -> DataFrame:
    """Lists, time stamps, 32-bit floats and the named (nullable) columns in a form every engine prints alike."""
    def one(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if field.name in as_text:
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(column.cast("array<string>"), "|").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, T.FloatType):
            return column.cast("double").alias(field.name)
        return column
    return df.select(*[one(f) for f in df.schema.fields])


def _records(nest, spark: SparkSession, sf: str, source: str) -> DataFrame:
    return nest(_dealt(table(spark, sf, source), 0 if source == "documents" else ROWS_PER_TASK))


def _dealt(rows: DataFrame, per_task: int = 0) -> DataFrame:
    """Rows by their first column: the tables come as one unsplittable file, which building nested records would keep on one core.

    Tasks are as large as Spark makes them by the bytes that they read, or, with ``per_task``, have about so many rows. That is for tables of numbers: a dozen
    bytes of them become kilobytes of nested records and of aggregation, so that bytes read say nothing about memory.
    """
    if not per_task:
        return rows.repartition(rows.columns[0])
    # counted from the footers of the files
    return rows.repartition(max(ceil(rows.count() / per_task), rows.sparkSession.sparkContext.defaultParallelism), rows.columns[0])


def _events_day(events: DataFrame) -> DataFrame:
    return events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))


# -- sources ------------------------------------------------------------------------------------------------------

def scan_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Records as JSON lines, parsed with the work schema narrowed to three fields."""
    lines = _records(nesting.line_works, spark, sf, "lineitem").select(F.to_json(F.struct("*")).alias("line"))
    parsed = lines.select(F.from_json("line", record_ddl("work", ("id", "authorships", "primary_location"))).alias("w"))
    return parsed.select(
        strip_id(F.col("w.id")).alias("work_id"), F.size("w.authorships").alias("n_authors"),
        F.col("w.authorships")[0]["raw_author_name"].alias("first_author"),
        strip_id(F.col("w.primary_location.source.id")).alias("source_id"),
        F.col("w.primary_location.is_oa").alias("is_oa"))


def _event_snapshot(spark: SparkSession, sf: str) -> str:
    """The events as a dated snapshot of gzipped JSON lines, one file a day, with merge lists of the errors; returns its root."""
    root = work_dir(spark, "snapshot")
    events = _events_day(table(spark, sf, "events"))
    lines = events.select(F.col("day").alias("updated_date"), F.to_json(F.struct(
        url("W", F.col("event_id")).alias("id"), F.col("event_type").alias("title"),
        F.col("user_id").alias("cited_by_count"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("updated_date"))).alias("value"))
    lines.repartition("updated_date").write.partitionBy("updated_date").option("compression", "gzip").text(f"{root}/data/works")
    lists = events.where("event_type = 'error'").select(
        "day", F.col("day").alias("merge_date"), url("W", F.col("event_id")).alias("id"), url("W", F.col("user_id")).alias("merge_into_id"))
    lists.repartition("day").write.partitionBy("day").option("header", True).option("compression", "gzip").csv(f"{root}/lists")
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(f"{root}/data/merged_ids/works"))
    for status in files.globStatus(path(f"{root}/lists/day=*/*.csv.gz")):  # a list's name is its date
        day = status.getPath().getParent().getName().removeprefix("day=")
        files.rename(status.getPath(), path(f"{root}/data/merged_ids/works/{day}.csv.gz"))
    return root


def incremental_since(spark: SparkSession, sf: str) -> DataFrame:
    """Write the events as a dated snapshot of gzipped JSON lines, then read the partitions newer than a watermark."""
    records = read_entity(spark, _event_snapshot(spark, sf), "work", SINCE, only=("id", "title", "cited_by_count", "updated_date"),
                          provenance=True)
    return records.select(strip_id(F.col("id")).alias("id"), "title", "cited_by_count", "updated_date", "partition_date")


def merged_lists_applied(spark: SparkSession, sf: str) -> DataFrame:
    """Orders without those that merge lists, read as files newer than a watermark, name."""
    orders = table(spark, sf, "orders").withColumn("id", strip_id(url("W", F.col("o_orderkey"))))
    gone = read_merged_ids(spark, _event_snapshot(spark, sf), "work", SINCE).select(strip_id(F.col("id")).alias("id"))
    return plain(delete_by_key(orders, gone, "id").drop("id"))


def snapshot_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Dates of the files still to be read after a run that finished those up to a date, and of merge lists newer than the watermark."""
    root, lake = _event_snapshot(spark, sf), LakeTables(spark, work_dir(spark, "lake"), buckets=4)
    files = list_files(spark, root, "work")
    finished = files.where(F.regexp_extract("file_path", "updated_date=([^/]+)", 1) <= SINCE)
    targets = ["work tables", "work search"]
    lake.commit(1, {}, for_targets(finished, targets), dict.fromkeys(targets, SINCE))
    pending = unprocessed(files, lake.processed(targets), ["file_path"])
    lists = list_merge_files(spark, root, "work", min(lake.watermarks().values()))
    return pending.unionByName(lists, allowMissingColumns=True).select(
        F.when(F.col("length").isNull(), "merge list").otherwise("records").alias("kind"),
        F.regexp_extract("file_path", r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1).alias("day"))


def watermark_advance(spark: SparkSession, sf: str) -> DataFrame:
    """Watermarks per target after one run for each day of events, where each event type is a target."""
    lake = LakeTables(spark, work_dir(spark, "lake"), buckets=4)
    days = _events_day(table(spark, sf, "events")).groupBy("event_type").agg(F.min("day").alias("first"), F.max("day").alias("last")).collect()
    for column in ("last", "first"):  # an older date committed later does not move a watermark back
        lake.commit(lake.next_commit(), {}, watermarks={row["event_type"]: row[column] for row in days})
    return spark.createDataFrame(sorted(lake.watermarks().items()), "target string, watermark string")


def merged_ids(spark: SparkSession, sf: str) -> DataFrame:
    events = _events_day(table(spark, sf, "events"))
    lists = events.where((F.col("event_type") == "error") & (F.col("day") > SINCE))
    return present_ids(lists.select(url("W", F.nullif(F.col("user_id"), F.lit(7))).alias("id"))).select(
        strip_id(F.col("id")).alias("id"))


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Institution records with planted faults; every record with the rules it breaks."""
    key, kind, user = F.col("event_id"), F.col("event_type"), F.col("user_id")
    lines = _dealt(table(spark, sf, "events")).select(key, kind, F.to_json(F.struct(
        F.when(key % 10 > 0, url("I", key)).alias("id"),
        F.when(user % 6 == 0, "many").alias("cited_by_count"),
        F.when(kind == "signup", "education").when(kind == "click", "club").alias("type"),
        F.when(user % 4 > 0, F.array().cast("array<struct<year:int>>")).alias("counts_by_year"),
        F.lit(1).alias("field_of_no_interest"),
        F.when(kind == "view", "not a date").otherwise("2024-01-01").alias("created_date"),
        F.array(F.struct(url("I", user).alias("id"), F.when(kind != "error", "child").alias("relationship"))
                ).alias("associated_institutions"))).alias("line"))
    broken = F.when(kind == "purchase", F.expr("left(line, length(line) - 1)")).otherwise(F.col("line"))
    parsed = lines.select(key, F.from_json(broken, record_ddl("institution") + f", {CORRUPT} string",
                                           {"columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    return mark(parsed.select("event_id", "r.*"), "institution").select("event_id", "reject_reason")


def quarantine_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Institution records with values of wrong types; every record with the paths of these."""
    key, kind, user = F.col("event_id"), F.col("event_type"), F.col("user_id")
    year = F.when(user % 4 == 0, "1.5").when(user % 4 == 1, "2001").when(user % 4 == 2, '"2001"').otherwise("null")
    lines = _dealt(table(spark, sf, "events")).select(key, F.concat(
        F.lit('{"id": 7, "cited_by_count": '), F.when(user % 6 == 0, '"many"').otherwise(user.cast("string")),
        F.lit(', "geo": '), F.when(key % 7 == 0, '"here"').otherwise(F.concat(
            F.lit('{"latitude": '), F.when(user % 5 == 0, '"north"').otherwise("12.5"), F.lit("}"))),
        F.lit(', "counts_by_year": '), F.when(kind == "error", '{"year": 2001}').otherwise(F.concat(
            F.lit('[{"year": 2000}, {"year": '), year, F.lit("}]"))),
        F.when(kind != "purchase", "}").otherwise("")).alias(CORRUPT))
    return with_wrong_types(lines, "institution").select("event_id", "wrong_types")


def resume_skip_processed(spark: SparkSession, sf: str) -> DataFrame:
    """Pending inputs (one per event type and day) without those an earlier run has finished."""
    events = _events_day(table(spark, sf, "events"))
    pending = events.select("event_type", "day").distinct()
    finished = events.where(F.col("value") > 240).select("event_type", "day")
    return unprocessed(pending, finished, ["event_type", "day"])


# -- functions ----------------------------------------------------------------------------------------------------

def empty_as_null_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("lang"), "text")
    return empty_as_null(docs)


def strip_id_query(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    full = url("A", key)
    given = (F.when(key % 5 == 0, F.lit(None).cast("string")).when(key % 5 == 1, "")
             .when(key % 5 == 2, F.substr(full, F.lit(1), F.lit(20))).when(key % 5 == 3, nesting.PREFIX).otherwise(full))
    return table(spark, sf, "customer").select("c_custkey", strip_id(given).alias("id"))


def clean_list_query(spark: SparkSession, sf: str) -> DataFrame:
    items = F.array(F.col("p_name"), F.lit(None).cast("string"), F.lit(""), F.lit("\"'"),
                    F.concat(F.col("p_brand"), F.lit(",\" "), F.col("p_type"), F.lit("'")))
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(clean_list(items), "|").alias("cleaned"),
        clean_list(F.when(F.col("p_size") > 25, F.array(F.lit("")))).isNull().alias("nothing_left"))


def clean_list_strip_query(spark: SparkSession, sf: str) -> DataFrame:
    lineage = F.array(url("P", F.col("s_nationkey")), F.lit("short"), F.lit(nesting.PREFIX), url("P,", F.col("s_suppkey")))
    return table(spark, sf, "supplier").select(
        "s_suppkey", F.array_join(clean_list(lineage, strip=True), "|").alias("lineage"))


def abstract_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    docs = _dealt(table(spark, sf, "documents"))
    return docs.select("doc_id", blank_to_null(rebuild_abstract(build_index(words(F.col("text"))))).alias("abstract"))


def abstract_two_shapes(spark: SparkSession, sf: str) -> DataFrame:
    works = _records(nesting.text_works, spark, sf, "documents")
    return works.select("doc_id", abstract_text(F.col("abstract_inverted_index")).alias("abstract"))


def title_abstract_query(spark: SparkSession, sf: str) -> DataFrame:
    lang = F.col("lang")
    title = F.when(~lang.isin("fr", "es"), F.col("source"))
    abstract = F.when(~lang.isin("de", "es"), F.col("text"))
    return table(spark, sf, "documents").select("doc_id", title_abstract(title, abstract).alias("title_abstract"))


def grants_json_query(spark: SparkSession, sf: str) -> DataFrame:
    works = _records(nesting.order_works, spark, sf, "orders")
    return works.select(strip_id(F.col("id")).alias("id"), grants_json(F.col("grants")).alias("grants"),
                        mesh_json(F.col("mesh")).alias("mesh"))


def apc_union(spark: SparkSession, sf: str) -> DataFrame:
    works = _records(nesting.order_works, spark, sf, "orders")
    return plain(works.select(strip_id(F.col("id")).alias("id"), apc_value(F.col("apc_paid")).alias("apc_paid"),
                              F.col("apc_list.value_usd").alias("apc_list")), as_text=("apc_paid", "apc_list"))


def typed_load_query(spark: SparkSession, sf: str) -> DataFrame:
    """Events as text, some of it not convertible: typed rows and rejected rows."""
    kind, key = F.col("event_type"), F.col("event_id")
    text = table(spark, sf, "events").select(
        key, F.when(kind == "error", "n/a").when(kind != "view", F.col("value").cast("string")).alias("value"),
        F.when(key % 9 == 0, "later").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("ts"),
        F.when(key % 2 == 0, "true").when(key % 3 == 0, "maybe").alias("flag"))
    good, rejects = typed_load(text, {"value": "double", "ts": "timestamp_ntz", "flag": "boolean"})
    loaded = plain(good, as_text=("flag",)).withColumn("reject_reason", F.lit(None).cast("string"))
    return loaded.unionByName(rejects.select("event_id", "reject_reason"), allowMissingColumns=True)


def tokenize_query(spark: SparkSession, sf: str) -> DataFrame:
    tokens = tokenize(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.size(tokens).alias("n_tokens"),
                                                F.array_join(tokens, " ").alias("tokens"))


def tokenize_words_query(spark: SparkSession, sf: str) -> DataFrame:
    tokens = tokenize_words(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.size(tokens).alias("n_tokens"), F.array_join(tokens, " ").alias("tokens"))


def literal_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Lists of awkward items as their literal and back."""
    items = F.array(F.coalesce("text", F.lit("none")), "source", F.lit(""), F.lit("null"), F.lit('a"b\\c,{d} '), "lang")
    back = parse_literal(array_literal(items))
    return table(spark, sf, "documents").select("doc_id", F.size(back).alias("n_items"), F.array_join(back, "|", "(null)").alias("items"))


# -- projections --------------------------------------------------------------------------------------------------

def works_projection(spark: SparkSession, sf: str) -> DataFrame:
    return plain(flatten.works(_records(nesting.order_works, spark, sf, "orders")),
                 as_text=("id_mag", "apc_paid", "apc_list", "oa_any_repository_has_fulltext"))


def authors_projection(spark: SparkSession, sf: str) -> DataFrame:
    return plain(flatten.authors(_records(nesting.customer_authors, spark, sf, "customer")), as_text=("id_mag",))


def institutions_projection(spark: SparkSession, sf: str) -> DataFrame:
    return plain(flatten.institutions(_records(nesting.supplier_institutions, spark, sf, "supplier")))


def publishers_projection(spark: SparkSession, sf: str) -> DataFrame:
    rows = flatten.publishers(_records(nesting.nation_publishers, spark, sf, "nation"))
    return plain(flatten.accept(rows, "publishers"))


def funders_projection(spark: SparkSession, sf: str) -> DataFrame:
    return plain(flatten.funders(_records(nesting.supplier_funders, spark, sf, "supplier")))


def concepts_projection(spark: SparkSession, sf: str) -> DataFrame:
    return plain(flatten.concepts(_records(nesting.part_concepts, spark, sf, "part")))


def sources_projection(spark: SparkSession, sf: str) -> DataFrame:
    return plain(flatten.sources(_records(nesting.part_sources, spark, sf, "part")))


def search_documents(spark: SparkSession, sf: str) -> DataFrame:
    works = _records(nesting.text_works, spark, sf, "documents")
    return plain(search.search_documents(works.select(*SEARCH_FIELDS)))


# -- link tables --------------------------------------------------------------------------------------------------

def _links(name: str, nest, source: str, unique_records: bool = True):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return plain(flatten.accept(flatten.FLATTEN[name](_records(nest, spark, sf, source)), name, unique_records))
    query.__doc__ = f"Rows of ``{name}``, one per key."
    return query


def is_primary_location(spark: SparkSession, sf: str) -> DataFrame:
    return plain(flatten.works_locations(_records(nesting.line_works, spark, sf, "lineitem")))


def drop_missing_key(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(
        strip_id(F.when(key % 3 == 0, "short").when(key % 3 == 1, url("A", key))).alias("id"), "c_name")
    return not_null_split(rows, ("id",))[0]


# -- keyed delete, replace, merge -----------------------------------------------------------------------------------

def _large_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").where(F.col("l_quantity") > 45).select(F.col("l_orderkey").alias("id"))


def delete_by_key_query(spark: SparkSession, sf: str) -> DataFrame:
    return plain(delete_by_key(table(spark, sf, "orders"), _large_lines(spark, sf), "o_orderkey"))


def cascade_delete_query(spark: SparkSession, sf: str) -> DataFrame:
    """Rows left per table after deleting the ids of error events from works and two of their link tables."""
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    tables = {"works": orders.select(F.col("o_orderkey").alias("id")),
              "works_authorships": lines.select(F.col("l_orderkey").alias("work_id"), "l_suppkey"),
              "works_references": lines.select(F.col("l_orderkey").alias("work_a_id"), F.col("l_partkey").alias("work_b_id"))}
    ids = table(spark, sf, "events").where(F.col("event_type") == "error").select(F.col("event_id").alias("id"))
    specs = [TABLES[name] for name in tables]
    left = cascade_delete(tables, specs, ids, ROWS_PER_TASK)
    counts = [left[s.name].groupBy(F.col(s.owner).alias("id")).agg(F.count("*").alias("n"))
              .select(F.lit(s.name).alias("table_name"), "id", "n") for s in specs]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def merged_delete(spark: SparkSession, sf: str) -> DataFrame:
    events = _events_day(table(spark, sf, "events"))
    merged = present_ids(events.where((F.col("event_type") == "error") & (F.col("day") > SINCE)), "event_id")
    return plain(delete_by_key(table(spark, sf, "orders"), merged, "o_orderkey"))


def _old_and_new_orders(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All orders, cut at one date."""
    orders = table(spark, sf, "orders")
    return orders.where("o_orderdate < '2001-06-01'"), orders.where("o_orderdate >= '2001-06-01'")


def replace_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Old orders of customers without new ones, plus the new ones."""
    old, new = _old_and_new_orders(spark, sf)
    return plain(replace_rows(old, new, "o_custkey", hot_owners=True))


def replace_children(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of changed orders are exchanged for their new lines; some changed orders have none left."""
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    changed = orders.where("o_orderdate >= '2001-01-01' or o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id"))
    new = lines.join(changed.withColumnRenamed("id", "l_orderkey"), "l_orderkey", "left_semi").where("l_returnflag = 'N'")
    return plain(replace_rows(lines, new, "l_orderkey", changed, hot_owners=True))


def lake_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs against the stored lake table: load old citations, then exchange those of the works that came again."""
    lake = LakeTables(spark, work_dir(spark, "lake"), buckets=16)
    spec = TABLES["works_references"]
    old, _ = _old_and_new_orders(spark, sf)
    again = table(spark, sf, "orders").where("o_orderstatus = 'P' or o_orderdate >= '2001-06-01'").withColumn(
        "o_custkey", F.col("o_custkey") + 1)
    for number, part in enumerate([old, again], start=1):
        records = nesting.order_works(part)
        changed = records.select(strip_id(F.col("id")).alias("id"))
        links = flatten.accept(flatten.works_references(records), spec.name, unique_records=True)
        lake.commit(number, exchange(lake, [spec], {spec.name: links}, changed))
    return lake.read(spec)


def latest_wins_query(spark: SparkSession, sf: str) -> DataFrame:
    return plain(latest_wins(table(spark, sf, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]))


def drop_stale_query(spark: SparkSession, sf: str) -> DataFrame:
    """Events that are not older than the newest error of the same user."""
    events = table(spark, sf, "events").select("event_id", F.col("user_id").alias("id"), F.col("ts").alias("updated_date"),
                                               "event_type")
    current = events.where("event_type = 'error'").groupBy("id").agg(F.max("updated_date").alias("updated_date"))
    return plain(drop_stale(events, current))


def stream_replace(spark: SparkSession, sf: str) -> DataFrame:
    """The events file as a stream, kept as the newest row of each user."""
    out = work_dir(spark, "stream")
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    columns = {f.name: f.dataType.simpleString() for f in schema.fields}
    spec = TableSpec("events", "work", columns, "user_id", ("user_id",), ("user_id",))
    return plain(run_stream_replace(stream, spec, f"{out}/lake", f"{out}/checkpoint",
                                    [F.desc("ts"), F.desc("event_id")], buckets=8))


# -- metrics and order ----------------------------------------------------------------------------------------------

def _event_file(day: Column, kind: Column) -> Column:
    return F.concat(F.lit("file:///snapshot/data/works/updated_date="), day, F.lit("/part_"), kind, F.lit(".gz"))


def partition_metrics_query(spark: SparkSession, sf: str) -> DataFrame:
    events = _events_day(table(spark, sf, "events"))
    rows = events.select(partition_label(_event_file(F.col("day"), F.col("event_type"))).alias("partition_label"),
                         F.when(F.col("value") > 30, F.col("props")).alias("abstract"))
    return partition_metrics(rows)


def pending_partitions(spark: SparkSession, sf: str) -> DataFrame:
    events = _events_day(table(spark, sf, "events")).where(F.col("day") > SINCE)
    files = events.select(F.col("event_type").alias("entity"), _event_file(F.col("day"), F.col("user_id").cast("string")).alias("file_path"))
    merges = events.where("event_type <> 'click'").select(F.col("event_type").alias("entity"), F.col("day").alias("file_path"))
    return pending_counts(files, merges)


def sort_missing_last(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.when(F.col("lang") != "en", F.col("lang")).alias("language"), "n_chars")
    return search.sort_missing_last(docs, "language", descending=True)


# -- lookups --------------------------------------------------------------------------------------------------------

def _works(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.works(_records(nesting.order_works, spark, sf, "orders"))


def _citations(spark: SparkSession, sf: str) -> DataFrame:
    references = flatten.works_references(_records(nesting.order_works, spark, sf, "orders"))
    return flatten.accept(references, "works_references", unique_records=True)


def lookup_doi(spark: SparkSession, sf: str) -> DataFrame:
    dois = [f"https://doi.test/10.1/{n}" for n in (1, 9, 17, 500, 1001)]
    return lookups.by_doi(_works(spark, sf), *dois).select("id", "id_doi", "title")


def lookup_id(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.by_id(_works(spark, sf), "W3", "W77", "W1200").select("id", "display_name")


def works_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.by_year(_works(spark, sf), 1996, 1997).select("id", "publication_year", "publication_date")


def works_by_year_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the stored table, whose files are ordered by year, type and id together."""
    lake, spec = LakeTables(spark, work_dir(spark, "lake"), buckets=4), TABLES["works"]
    lake.commit(1, {spec.name: lake.write(spec, _works(spark, sf), list(range(4)))})
    return lookups.by_year(lake.read(spec), 1996, 1997).select("id", "publication_year", "publication_date")


def works_by_fields(spark: SparkSession, sf: str) -> DataFrame:
    chosen = lookups.select_works(_works(spark, sf), language=["en", "de"], is_oa=True,
                                  publication_date=("1997-03-01", "1999-12-31"), is_paratext=False)
    return chosen.select("id", "language", "publication_date", "type")


def works_of_author(spark: SparkSession, sf: str) -> DataFrame:
    """Every authorship with its work's title and its author's name."""
    lines, orders, supplier = (table(spark, sf, t) for t in ("lineitem", "orders", "supplier"))
    return lookups.authors_of_works(
        orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title")),
        lines.select(F.col("l_orderkey").alias("work_id"), F.col("l_suppkey").alias("author_id"),
                     F.col("l_linenumber").alias("exact_position")),
        supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("display_name")))


def works_of_one_author(spark: SparkSession, sf: str) -> DataFrame:
    links = flatten.works_authorships(_records(nesting.line_works, spark, sf, "lineitem"))
    return lookups.works_of_author(_works(spark, sf), links, "A42").select("id", "title", "publication_year")


def sql_views(spark: SparkSession, sf: str) -> DataFrame:
    """SQL over registered tables: open-access works and citations received per language.

    Citations are counted per cited work before the join, so a very much cited work arrives there as one row.
    """
    tables = {"works": _works(spark, sf),
              "works_references": _citations(spark, sf)}
    lookups.register_views(tables.__getitem__, list(tables), prefix="lake_")
    return spark.sql("""
        WITH cited AS (SELECT work_b_id, count(*) AS n FROM lake_works_references GROUP BY work_b_id)
        SELECT w.language, count(*) AS n_works, coalesce(sum(c.n), 0) AS n_citations
        FROM lake_works w LEFT JOIN cited c ON c.work_b_id = w.id
        WHERE w.is_oa GROUP BY w.language""")


def citation_counts(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.citation_counts(_citations(spark, sf))


def concept_closure(spark: SparkSession, sf: str) -> DataFrame:
    """Every concept above each concept, over any number of edges."""
    edges = QUERIES["concept_ancestors"](spark, sf)
    return lookups.closure(edges, "concept_a_id", "concept_b_id", work_dir(spark, "closure"))


def citation_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return lookups.neighbours(_citations(spark, sf), "W40", "work_a_id", "work_b_id")


# -- search ---------------------------------------------------------------------------------------------------------

QUERY = "token of the licence"
SYNONYMS = {"licence": ["license"]}


def _search_docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", "lang", "source")


def search_any(spark: SparkSession, sf: str) -> DataFrame:
    terms = analyze_query("token licence", synonyms=SYNONYMS)
    return search.match_any(search.postings(_search_docs(spark, sf), "text", terms=terms), terms)


def search_all(spark: SparkSession, sf: str) -> DataFrame:
    terms = analyze_query("in the licence", stop_words=("IN",), synonyms=SYNONYMS)
    return search.match_all(search.postings(_search_docs(spark, sf), "text", terms=terms), terms)


def search_phrase(spark: SparkSession, sf: str) -> DataFrame:
    """Every place of a phrase."""
    return search.phrase_places(_search_docs(spark, sf), "text", analyze_query("Of the"))


def search_phrase_gap(spark: SparkSession, sf: str) -> DataFrame:
    """A phrase with stop words inside and a synonym of several words: "under the M.I.T. license" or "under the apache license"."""
    terms = analyze_query("under the licence", stop_words=("the", "is"), synonyms={"licence": ["MIT license", "Apache License"]})
    index = search.postings(_search_docs(spark, sf), "text", stop_words=("the", "is"), terms=terms)
    return search.match_phrase(index, terms).select("id", "start")


def search_bm25(spark: SparkSession, sf: str) -> DataFrame:
    docs = _search_docs(spark, sf)
    terms = analyze_query(QUERY, synonyms=SYNONYMS)
    return search.bm25_scan(docs, "text", terms, k=100).select("id", F.round("score", 6).alias("score"))


def search_bm25_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The same ranking from postings and lengths."""
    docs, terms = _search_docs(spark, sf), analyze_query(QUERY, synonyms=SYNONYMS)
    best = search.bm25(search.postings(docs, "text", terms=terms), search.document_lengths(docs, "text"), terms, k=100)
    return best.select("id", F.round("score", 6).alias("score"))


def search_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Ranking over four fields: the first words as a title, the text, and two short ones."""
    docs = _search_docs(spark, sf).withColumn("title", F.substring_index("text", " ", 8))
    best = search.search_fields(docs, {"title": 3.0, "text": 1.0, "source": 2.0, "lang": 0.5}, analyze_query(QUERY + " en", synonyms=SYNONYMS), k=100)
    return best.select("id", F.round("score", 6).alias("score"))


def search_near(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with "under" and "licence" within five words."""
    return search.near(_search_docs(spark, sf), "text", analyze_query("under licence", synonyms=SYNONYMS), 3)


def search_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by length, and how many sources they come from."""
    return search.histogram(table(spark, sf, "documents"), "n_chars", 500, 500, 10000, distinct="source")


def search_facets(spark: SparkSession, sf: str) -> DataFrame:
    docs = _search_docs(spark, sf).where(has_any(tokenize(F.col("text")), analyze_query("token licence", synonyms=SYNONYMS)))
    return search.facets(docs, ["lang", "source"])


# -- files ----------------------------------------------------------------------------------------------------------

def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Publications as gzipped CSV and back into typed columns; abstracts hold line breaks, commas and quotes."""
    path = work_dir(spark, "csv")
    spec = TABLES["works"]
    docs = table(spark, sf, "documents").select(
        F.concat(F.lit("W"), F.col("doc_id").cast("string")).alias("id"), F.col("text").alias("abstract"),
        F.col("source").alias("title"), (F.col("lang") == "en").alias("is_oa"), F.col("n_chars").cast("int").alias("cited_by_count"))
    missing = {c: F.lit(None).cast(kind) for c, kind in spec.columns.items() if c not in docs.columns}
    write_csv(docs.withColumns(missing), spec, path)
    return read_csv(spark, spec, path).select("id", "title", "abstract", "is_oa", "cited_by_count", "language")


def json_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Search documents as JSON lines and back."""
    path = work_dir(spark, "json")
    docs = search.search_documents(_records(nesting.text_works, spark, sf, "documents").select(*SEARCH_FIELDS))
    write_json(docs, path)
    back = spark.read.schema(SEARCH_TABLE.ddl).json(path)
    return plain(back.select("id", "title_abstract", "mag", "is_oa", "cited_by_count", "language"))


def clear_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a lake table before and after it is cleared and loaded again with the orders of one status."""
    lake, spec = LakeTables(spark, work_dir(spark, "lake"), buckets=4), TABLES["works_references"]
    rows = []
    for step, part in (("loaded", table(spark, sf, "orders")), ("cleared", None), ("loaded again", table(spark, sf, "orders").where("o_orderstatus = 'P'"))):
        if part is None:
            lake.clear([spec])
        else:
            records = nesting.order_works(part)
            links = flatten.accept(flatten.works_references(records), spec.name, unique_records=True)
            changed = records.select(strip_id(F.col("id")).alias("id"))
            lake.commit(lake.next_commit(), exchange(lake, [spec], {spec.name: links}, changed))
        rows.append(lake.read(spec).agg(F.lit(step).alias("step"), F.count("*").alias("n")))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


QUERIES = {
    "scan_nested": scan_nested,
    "incremental_since": incremental_since,
    "merged_ids": merged_ids,
    "merged_lists_applied": merged_lists_applied,
    "snapshot_resume": snapshot_resume,
    "watermark_advance": watermark_advance,
    "quarantine": quarantine,
    "quarantine_fields": quarantine_fields,
    "resume_skip_processed": resume_skip_processed,
    "empty_as_null": empty_as_null_query,
    "strip_id": strip_id_query,
    "clean_list": clean_list_query,
    "clean_list_strip": clean_list_strip_query,
    "abstract_rebuild": abstract_rebuild,
    "abstract_two_shapes": abstract_two_shapes,
    "title_abstract": title_abstract_query,
    "grants_json": grants_json_query,
    "apc_union": apc_union,
    "typed_load": typed_load_query,
    "tokenize": tokenize_query,
    "tokenize_words": tokenize_words_query,
    "literal_round_trip": literal_round_trip,
    "works_projection": works_projection,
    "authors_projection": authors_projection,
    "institutions_projection": institutions_projection,
    "publishers_projection": publishers_projection,
    "funders_projection": funders_projection,
    "concepts_projection": concepts_projection,
    "sources_projection": sources_projection,
    "search_documents": search_documents,
    "explode_edges": _links("institutions_associations", nesting.supplier_institutions, "supplier"),
    "institutions_concepts": _links("institutions_concepts", nesting.supplier_institutions, "supplier"),
    "concepts_related": _links("concepts_related", nesting.part_concepts, "part"),
    "concept_ancestors": _links("concepts_ancestors", nesting.part_concepts, "part"),
    "works_concepts": _links("works_concepts", nesting.line_works, "lineitem", unique_records=False),
    "works_sdgs": _links("works_sdgs", nesting.line_works, "lineitem", unique_records=False),
    "citation_edges": _links("works_references", nesting.order_works, "orders"),
    "works_related": _links("works_related", nesting.order_works, "orders"),
    "authorships_posexplode": _links("works_authorships", nesting.line_works, "lineitem", unique_records=False),
    "explode_two_level": _links("works_authorship_institutions", nesting.line_works, "lineitem", unique_records=False),
    "is_primary_location": is_primary_location,
    "drop_missing_key": drop_missing_key,
    "delete_by_key": delete_by_key_query,
    "cascade_delete": cascade_delete_query,
    "merged_delete": merged_delete,
    "replace_upsert": replace_upsert,
    "replace_children": replace_children,
    "lake_replace": lake_replace,
    "latest_wins": latest_wins_query,
    "drop_stale": drop_stale_query,
    "stream_replace": stream_replace,
    "partition_metrics": partition_metrics_query,
    "pending_partitions": pending_partitions,
    "sort_missing_last": sort_missing_last,
    "lookup_doi": lookup_doi,
    "lookup_id": lookup_id,
    "works_by_year": works_by_year,
    "works_by_year_pruned": works_by_year_pruned,
    "works_by_fields": works_by_fields,
    "works_of_author": works_of_author,
    "works_of_one_author": works_of_one_author,
    "sql_views": sql_views,
    "citation_counts": citation_counts,
    "concept_closure": concept_closure,
    "citation_neighbours": citation_neighbours,
    "search_any": search_any,
    "search_all": search_all,
    "search_phrase": search_phrase,
    "search_phrase_gap": search_phrase_gap,
    "search_bm25": search_bm25,
    "search_bm25_indexed": search_bm25_indexed,
    "search_fields": search_fields,
    "search_near": search_near,
    "search_histogram": search_histogram,
    "search_facets": search_facets,
    "csv_round_trip": csv_round_trip,
    "json_round_trip": json_round_trip,
    "clear_tables": clear_tables,
}
