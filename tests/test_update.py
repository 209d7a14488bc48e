"""Whole runs over a small snapshot that holds the edge cases."""

import datetime
import json
import shutil
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from scholar_lake.config import Settings, work_dir
from scholar_lake.operators.flatten import rejected, works_authorship_institutions
from scholar_lake.plans.update import partition_report, register_lake, run_update
from scholar_lake.schemas import ENTITIES, SEARCH_TABLE, TABLES, tables_of
from scholar_lake.sinks.exports import read_csv, write_csv, write_jdbc, write_json
from scholar_lake.sinks.tables import LakeTables
from scholar_lake.sources.merged_ids import list_merge_files, read_merged_ids
from scholar_lake.sources.snapshot import list_files, pending_counts, read_entity
from scholar_lake.streaming.ingest import stream_update

P = "https://scholar.test/"
STATS = {"summary_stats": {"h_index": 1, "i10_index": 2}}


def work(n, **more):
    base = {"id": f"{P}W{n}", "ids": {"openalex": f"{P}W{n}", "mag": n, "doi": f"d{n}"}, "title": f"title {n}",
            "updated_date": "2023-05-01T01:02:03.456789", "created_date": "2023-01-01", "publication_date": "2022-02-02",
            "publication_year": 2022, "authorships": [], "concepts": [], "referenced_works": [], "related_works": []}
    return {**base, **more}


def author(letter, institutions=()):
    return {"author": {"id": letter and f"{P}{letter}", "display_name": "x"}, "author_position": "first",
            "institutions": [{"id": f"{P}{i}"} for i in institutions]}


FIRST = [
    work(1, abstract_inverted_index={"b\n": [1], 'a,"': [0, 2]}, nonsense=[1, {"x": 2}],
         authorships=[author("A1", ["I1", "I1", "I2"]), author(None, ["I1"])],
         primary_location={"source": {"id": f"{P}S1", "display_name": "s"}, "version": "v", "pdf_url": None},
         locations=[{"source": {"id": f"{P}S1", "display_name": "s"}, "version": "v"}, {"version": "v"}],
         concepts=[{"id": f"{P}C1", "score": 0.5}, {"id": f"{P}C1", "score": 0.75}],
         referenced_works=[f"{P}W2", f"{P}W2", "short"], apc_paid=[{"value_usd": 3}], apc_list={"value_usd": 4},
         biblio={"volume": "7"}, mesh=[{"descriptor_ui": "D1"}], license="",
         grants=[{"funder": f"{P}F1", "funder_display_name": None, "award_id": "9"}]),
    work(2, abstract_inverted_index=json.dumps({"IndexLength": 2, "InvertedIndex": {"old": [0], "shape": [1]}}),
         apc_paid={"value_usd": 5}, ids={"openalex": "x", "mag": None}, related_works=[f"{P}W1"],
         sustainable_development_goals=[{"id": "https://goals.test/1", "display_name": "g", "score": 0.5}]),
    work(3, referenced_works=[f"{P}W4"], title=None),
    work(4, authorships=None, concepts=None, referenced_works=None),
    work(5, concepts=[{"id": f"{P}C1"}]),                       # no score
    work(6, open_access={"oa_status": "purple"}),               # unknown value
    work(7, publication_year="2022"),                           # wrong type
    work(8, ids={"mag": 8}),                                    # no self id
    work(9, created_date="some day"),
    '{"id": "' + P + 'W10", "title": ',                         # cut off
    work(11, id=None),
]


@pytest.fixture
def world(snapshot, tmp_path):
    snapshot.records("work", "2023-05-01", FIRST)
    snapshot.records("author", "2023-05-01", [
        {"id": f"{P}A1", **STATS, "ids": {"orcid": "o"}, "display_name": "A, One", "display_name_alternatives": ["a", None, "b,c"]},
        {"id": f"{P}A2", "ids": None}])
    snapshot.records("institution", "2023-05-01", [
        {"id": f"{P}I1", "counts_by_year": [], "type": "education", "geo": {"latitude": 1.5},
         "associated_institutions": [{"id": f"{P}I2", "relationship": "child"}], "x_concepts": [{"id": f"{P}C1", "score": 1}]},
        {"id": f"{P}I3", "counts_by_year": [], "associated_institutions": [{"id": f"{P}I1", "relationship": "twin"}]},
        {"id": f"{P}I4", "associated_institutions": []}])
    snapshot.records("publisher", "2023-05-01", [
        {"id": f"{P}P1", "counts_by_year": [], "lineage": [f"{P}P1", "x"], "parent_publisher": {"id": f"{P}P2"}},
        {"id": None, "counts_by_year": []}])
    snapshot.records("funder", "2023-05-01", [
        {"id": f"{P}F1", "counts_by_year": [], "ids": {"crossref": 100}}, {"id": f"{P}F2", "counts_by_year": []}])
    snapshot.records("concept", "2023-05-01", [
        {"id": f"{P}C1", "counts_by_year": [], "ancestors": [{"id": f"{P}C9"}], "related_concepts": [{"id": f"{P}C8", "score": 2.5}]}])
    snapshot.records("source", "2023-05-01", [
        {"id": f"{P}S1", "host_organization": f"{P}P1", "host_organization_lineage": [f"{P}P1"],
         "societies": [{"organization": "s, t"}], "ids": {"issn": ["1", "2"]}}])
    return snapshot, Settings(str(snapshot.root), str(tmp_path / "lake"), buckets=4)


def lake_rows(spark, settings, name, *columns):
    spec = SEARCH_TABLE if name == SEARCH_TABLE.name else TABLES[name]
    return sorted((tuple(r) for r in LakeTables(spark, settings.out, settings.buckets).read(spec).select(*columns).collect()),
                  key=str)


def test_first_run(spark, world):
    snapshot, settings = world
    report = run_update(spark, settings)
    assert (report.commit, report.since["work"], report.watermark["concept"]) == (1, "1970-01-01", "2023-05-01")
    assert report.metrics["work"] == {"records": 11, "rejects": 7}
    assert report.metrics["publisher"] == {"records": 2, "rejects": 1}

    works = {r["id"]: r for r in LakeTables(spark, settings.out, 4).read(TABLES["works"]).collect()}
    assert set(works) == {"W1", "W2", "W3", "W4"}
    one, two = works["W1"], works["W2"]
    assert one["abstract"] == 'a," b\n a,"' and two["abstract"] == "old shape"
    assert (one["apc_paid"], one["apc_list"], two["apc_paid"]) == (None, 4, 5)
    assert one["license"] is None and one["primary_location"] == "S1" and one["volume"] == "7"
    assert one["grants"] == '[{"funder":"F1","funder_display_name":null,"award_id":"9"}]'
    assert one["mesh"] == '[{"descriptor_ui":"D1"}]'
    assert one["updated_date"] == datetime.datetime(2023, 5, 1, 1, 2, 3, 456789)
    assert works["W3"]["title"] is None

    assert lake_rows(spark, settings, "works_authorships", "work_id", "author_id", "exact_position") == [
        ("W1", "A1", 0), ("W1", None, 1)]
    assert lake_rows(spark, settings, "works_authorship_institutions", "work_id", "author_id", "institution_id") == [
        ("W1", "A1", "I1"), ("W1", "A1", "I2")]
    assert lake_rows(spark, settings, "works_locations", "work_id", "source_id", "is_primary") == [
        ("W1", "S1", True), ("W1", None, False)]
    assert lake_rows(spark, settings, "works_concepts", "work_id", "concept_id", "score") == [("W1", "C1", 0.75)]
    assert lake_rows(spark, settings, "works_references", "*") == [("W1", "W2"), ("W3", "W4")]
    assert lake_rows(spark, settings, "works_related", "*") == [("W2", "W1")]
    assert lake_rows(spark, settings, "works_sdgs", "*") == [("W2", "https://goals.test/1", "g", 0.5)]
    assert lake_rows(spark, settings, "authors", "id", "display_name", "display_name_alternatives", "h_index", "id_orcid") == [
        ("A1", "A, One", ["a", "bc"], 1, "o"), ("A2", None, None, None, None)]
    assert lake_rows(spark, settings, "institutions", "id", "latitude") == [("I1", 1.5)]
    assert lake_rows(spark, settings, "institutions_associations", "*") == [("I1", "I2", "child")]
    assert lake_rows(spark, settings, "institutions_concepts", "*") == [("I1", "C1", 1.0)]
    assert lake_rows(spark, settings, "publishers", "id", "lineage", "parent") == [("P1", ["P1"], "P2")]
    assert lake_rows(spark, settings, "funders", "id", "id_crossref") == [("F1", "100")]
    assert lake_rows(spark, settings, "concepts", "id") == [("C1",)]
    assert lake_rows(spark, settings, "concepts_ancestors", "*") == [("C1", "C9")]
    assert lake_rows(spark, settings, "concepts_related", "*") == [("C1", "C8", 2.5)]
    assert lake_rows(spark, settings, "sources", "id", "host_organization", "host_organization_lineage", "societies", "id_issn") == [
        ("S1", f"{P}P1", ["P1"], ["s t"], ["1", "2"])]

    docs = {r["id"]: r for r in LakeTables(spark, settings.out, 4).read(SEARCH_TABLE).collect()}
    assert docs["W1"]["mag"] == "1" and docs["W2"]["mag"] is None
    assert docs["W1"]["title_abstract"] == 'title 1 a," b\n a,"' and docs["W3"]["title_abstract"] is None
    assert docs["W4"]["title_abstract"] == "title 4 " and docs["W1"]["publication_date"] == datetime.date(2022, 2, 2)
    assert json.loads(docs["W1"]["locations"])[1] == {"is_primary": False, "version": "v"}
    assert json.loads(docs["W1"]["authorships"])[1] == {
        "author": {"display_name": "x"}, "author_position": "first", "institutions": [{"id": f"{P}I1"}], "is_corresponding": None,
        "raw_affiliation_string": None}
    assert set(docs) == {"W1", "W2", "W3", "W4", "W5", "W6", "W8"}     # the tables' own rules do not hold for search
    assert docs["W1"]["biblio"] == '{"volume":"7"}'

    set_aside = spark.read.parquet(f"{settings.out}/quarantine/1/work")
    assert {r["id"][-2:] for r in set_aside.where("search_reject_reason = ''").collect()} == {"W5", "W6", "W8"}
    reasons = {(r["id"] or "")[-3:]: r["reject_reason"]
               for r in spark.read.parquet(f"{settings.out}/quarantine/1/work").collect()}
    assert reasons["/W5"] == "missing concepts[].score" and reasons["/W6"] == "unknown open_access.oa_status"
    assert reasons["/W7"] == "malformed" and reasons["/W8"] == "missing ids.openalex"
    assert reasons["/W9"] == "unparsable created_date"

    assert [tuple(r) for r in partition_report(spark, settings, report.run).collect()] == [("2023-05-01-part_000", 4, 2)]
    register_lake(spark, settings)
    assert spark.sql("SELECT count(*) FROM works w JOIN works_references r ON r.work_a_id = w.id").first()[0] == 2


def test_second_run_replaces_deletes_and_resumes(spark, world):
    snapshot, settings = world
    settings = replace(settings, buckets=64)
    run_update(spark, settings, entities=("work",))
    before = LakeTables(spark, settings.out, 64).live_paths("works")
    snapshot.records("work", "2023-05-01", [work(99)], part=1)     # on the watermark's day: not newer
    snapshot.records("work", "2023-06-01", [
        work(1, title="older", updated_date="2023-05-20", referenced_works=[f"{P}W9"]),
        work(1, title="newest", updated_date="2023-05-30", concepts=[{"id": f"{P}C2", "score": 0.5}]),
        work(12, title="merged but delivered")])
    snapshot.merged("work", "2023-05-01", [("W2", "W1")])             # not newer
    snapshot.merged("work", "2023-06-02", [("W4", "W1"), ("W12", "W1"), ("W4", "W1")])
    report = run_update(spark, settings, entities=("work",))
    assert (report.since, report.watermark) == ({"work": "2023-05-01"}, {"work": "2023-06-01"})
    assert lake_rows(spark, settings, "works", "id", "title") == [
        ("W1", "newest"), ("W12", "merged but delivered"), ("W2", "title 2"), ("W3", None)]
    assert lake_rows(spark, settings, "works_references", "*") == [("W3", "W4")]      # still refers to the deleted W4
    assert lake_rows(spark, settings, "works_concepts", "work_id", "concept_id") == [("W1", "C2")]
    assert lake_rows(spark, settings, "works_authorships", "*") == []
    assert [r[0] for r in lake_rows(spark, settings, "search_works", "id")] == ["W1", "W12", "W2", "W3", "W5", "W6", "W8"]
    assert any(path in LakeTables(spark, settings.out).live_paths("works") for path in before)   # W2, W3 stay put

    # nothing is new: the merge list is not applied a second time, the tables stay
    again = run_update(spark, settings, entities=("work",))
    assert again.metrics["work"]["records"] == 0
    assert [r[0] for r in lake_rows(spark, settings, "works", "id")] == ["W1", "W12", "W2", "W3"]
    # an explicit date reads finished files only with override
    old = replace(settings, since="1970-01-01")
    assert run_update(spark, old, entities=("work",)).metrics["work"]["records"] == 1          # W99's file
    assert run_update(spark, old, override=True, apply_deletes=False, entities=("work",)).metrics["work"]["records"] == 15


def test_progress_is_kept_per_entity_and_target(spark, world):
    _, settings = world
    run_update(spark, settings, tables=False, entities=("work", "concept"))
    assert len(lake_rows(spark, settings, "search_works", "id")) == 7 and lake_rows(spark, settings, "works", "id") == []
    run_update(spark, settings, search=False, entities=("work", "concept"))
    assert len(lake_rows(spark, settings, "works", "id")) == 4 and lake_rows(spark, settings, "concepts", "id") == [("C1",)]
    assert run_update(spark, settings, entities=("work",)).metrics["work"]["records"] == 0


def test_merge_lists_that_came_while_deletes_were_off_are_applied_later(spark, world):
    snapshot, settings = world
    run_update(spark, settings, entities=("work",))
    snapshot.merged("work", "2023-06-02", [("W3", "W1")])
    snapshot.records("work", "2023-06-05", [work(20)])
    run_update(spark, settings, entities=("work",), apply_deletes=False)
    assert [r[0] for r in lake_rows(spark, settings, "works", "id")] == ["W1", "W2", "W20", "W3", "W4"]
    run_update(spark, settings, entities=("work",))
    assert [r[0] for r in lake_rows(spark, settings, "works", "id")] == ["W1", "W2", "W20", "W4"]
    assert "W3" not in [r[0] for r in lake_rows(spark, settings, "search_works", "id")]


@pytest.mark.parametrize("override", [False, True])
def test_many_files_are_read_in_parts(spark, world, override):
    snapshot, settings = world
    snapshot.records("work", "2023-06-01", [work(1, title="second", updated_date="2023-06-01"), work(30)])
    snapshot.records("work", "2023-06-01", [work(31)], part=1)
    snapshot.records("work", "2023-06-02", [work(1, title="third", updated_date="2023-06-02")])
    snapshot.merged("work", "2023-06-02", [("W2", "W1"), ("W30", "W1")])
    report = run_update(spark, settings, entities=("work",), files_at_a_time=1, override=override)
    assert report.metrics["work"]["records"] == 15 and len(report.runs) == 3 and report.watermark == {"work": "2023-06-02"}
    assert lake_rows(spark, settings, "works", "id", "title") == [
        ("W1", "third"), ("W2", "title 2"), ("W3", None), ("W30", "title 30"), ("W31", "title 31"), ("W4", "title 4")]
    assert run_update(spark, settings, entities=("work",)).metrics["work"]["records"] == 0


def test_another_bucket_count_is_refused(spark, world):
    snapshot, settings = world
    run_update(spark, settings, entities=("concept",))
    with pytest.raises(ValueError, match="4 buckets"):
        run_update(spark, replace(settings, buckets=16), entities=("concept",))
    snapshot.records("concept", "2023-06-01", [{"id": f"{P}C{n}", "counts_by_year": []} for n in range(1, 9)])
    run_update(spark, replace(settings, buckets=None), entities=("concept",))
    assert [r[0] for r in lake_rows(spark, settings, "concepts", "id")] == [f"C{n}" for n in range(1, 9)]


def test_superseded_folders_are_removed(spark, world):
    snapshot, settings = world
    run_update(spark, settings, entities=("concept",))
    snapshot.records("concept", "2023-06-01", [{"id": f"{P}C1", "counts_by_year": [], "display_name": "new"}])
    run_update(spark, settings, entities=("concept",))
    lake = LakeTables(spark, settings.out)
    before = [lake.read(spec).collect() for spec in tables_of("concept")]
    gone = lake.remove_superseded()
    assert any("/tables/concepts/run=" in path for path in gone) and any("/staging/" in path for path in gone)
    assert [LakeTables(spark, settings.out).read(spec).collect() for spec in tables_of("concept")] == before
    assert lake.remove_superseded() == []


def test_a_run_that_dies_leaves_the_lake_as_it_was(spark, world, monkeypatch):
    snapshot, settings = world
    run_update(spark, settings, entities=("concept",))
    snapshot.records("concept", "2023-06-01", [{"id": f"{P}C1", "counts_by_year": [], "display_name": "new"}])
    with monkeypatch.context() as patch:
        patch.setattr(LakeTables, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run_update(spark, settings, entities=("concept",))
    assert lake_rows(spark, settings, "concepts", "display_name") == [(None,)]
    run_update(spark, settings, entities=("concept",))
    assert lake_rows(spark, settings, "concepts", "display_name") == [("new",)]
    assert lake_rows(spark, settings, "concepts_ancestors", "*") == []


def test_stream_equals_batch_and_late_files_lose(spark, world, tmp_path):
    snapshot, settings = world
    streamed = Settings(settings.root, str(tmp_path / "streamed"), buckets=4)
    run_update(spark, settings, entities=("work",))
    stream_update(spark, streamed, "work", files_per_batch=1)
    for spec in [*tables_of("work"), SEARCH_TABLE]:
        assert lake_rows(spark, streamed, spec.name, "*") == lake_rows(spark, settings, spec.name, "*")
    snapshot.records("work", "2023-06-01", [work(1, title="late", updated_date="2020-01-01"), work(2, title="new", updated_date="2023-06-01")])
    stream_update(spark, streamed, "work")
    titles = dict(lake_rows(spark, streamed, "works", "id", "title"))
    assert (titles["W1"], titles["W2"]) == ("title 1", "new")
    snapshot.merged("work", "2023-06-03", [("W3", "W1"), ("W9", "W1")])
    stream_update(spark, streamed, "work")
    for name in ("works", "search_works"):
        assert "W3" not in [r[0] for r in lake_rows(spark, streamed, name, "id")]
    commits = LakeTables(spark, streamed.out, 4).next_commit()
    stream_update(spark, streamed, "work")                     # nothing new, nothing committed
    assert LakeTables(spark, streamed.out, 4).next_commit() == commits


def test_a_new_checkpoint_starts_over_without_losing_batches(spark, world):
    snapshot, settings = world
    stream_update(spark, settings, "concept")
    for day, name in enumerate(("second", "third"), start=1):
        shutil.move(f"{settings.out}/checkpoints/concept", f"{settings.out}/old-{name}")
        snapshot.records("concept", f"2023-07-0{day}", [{"id": f"{P}C1", "counts_by_year": [], "display_name": name,
                                                                   "updated_date": f"2023-07-0{day}"}])
        stream_update(spark, settings, "concept")
        assert lake_rows(spark, settings, "concepts", "display_name") == [(name,)]


def files_read(df):
    """Files opened by the scan of a one-stage plan."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collect()
    while plan.children().nonEmpty():
        plan = plan.children().head()
    return plan.metrics().apply("numFiles").value()


def test_scan_prunes_files_and_counts_pending(spark, world):
    snapshot, settings = world
    snapshot.records("work", "2023-06-01", [work(20)])
    snapshot.merged("work", "2023-06-01", [("W1", "W2")])
    scan = read_entity(spark, settings.root, "work", "2023-05-01", only=("id", "updated_date"))
    assert [tuple(r) for r in scan.collect()] == [(f"{P}W20", "2023-05-01T01:02:03.456789")]   # the record's own date
    assert files_read(read_entity(spark, settings.root, "work", "2023-05-01")) == 1
    assert files_read(read_entity(spark, settings.root, "work")) == 2
    files = list_files(spark, settings.root, "work", "2023-04-01").unionByName(list_files(spark, settings.root, "source"))
    merges = list_merge_files(spark, settings.root, "work")
    assert sorted(map(tuple, pending_counts(files, merges).collect())) == [("source", 1, 0), ("work", 2, 1)]
    assert read_entity(spark, str(snapshot.root / "nowhere"), "work", provenance=True).count() == 0
    assert read_merged_ids(spark, str(snapshot.root / "nowhere"), "work").count() == 0
    assert [r.id for r in read_merged_ids(spark, settings.root, "work", "2023-05-31").collect()] == ["W1"]


def scanned_rows(df):
    """Rows that the scan of a one-stage plan hands out: those of the row groups it could not skip."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collect()
    while plan.children().nonEmpty():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_layout_skips_row_groups(spark, tmp_path):
    """Sorted ids and the bloom filter on DOIs, which are in no order, leave most of a bucket's row groups unread."""
    hadoop, spec = spark._jsc.hadoopConfiguration(), TABLES["works"]
    hadoop.set("parquet.block.size", str(64 * 1024))
    try:
        given = {"id": F.format_string("W%06d", "id"), "id_doi": F.sha2(F.col("id").cast("string"), 256), "title": F.sha2(F.col("id").cast("string"), 512)}
        rows = spark.range(20000).select(*[given.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in spec.columns.items()])
        lake = LakeTables(spark, str(tmp_path / "lake"), 1)
        lake.commit(1, {spec.name: lake.write(spec, rows, [0])})
    finally:
        hadoop.unset("parquet.block.size")
    stored = lake.read(spec)
    wanted = rows.where("id = 'W012345'").select("id_doi").first()[0]
    for condition in (F.col("id") == "W012345", F.col("id_doi") == wanted):
        found = stored.where(condition).select("id", "id_doi")
        assert [tuple(r) for r in found.collect()] == [("W012345", wanted)]
        assert scanned_rows(found) < 5000


def test_clustered_layout_skips_row_groups(spark, tmp_path):
    """Works lie ordered by year, type and id together: a filter on any of them leaves most row groups unread."""
    hadoop, spec = spark._jsc.hadoopConfiguration(), TABLES["works"]
    hadoop.set("parquet.block.size", str(64 * 1024))
    try:
        draw = F.xxhash64("id")
        given = {"id": F.format_string("W%06d", "id"), "title": F.sha2(F.col("id").cast("string"), 512),
                 "publication_year": 1960 + F.pmod(draw, F.lit(60)), "type": F.concat(F.lit("t"), F.pmod(F.shiftright(draw, 20), F.lit(8)))}
        rows = spark.range(20000).select(*[given.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in spec.columns.items()])
        lake = LakeTables(spark, str(tmp_path / "lake"), 1)
        lake.commit(1, {spec.name: lake.write(spec, rows, [0])})
    finally:
        hadoop.unset("parquet.block.size")
    stored = lake.read(spec)
    assert stored.count() == 20000
    for condition in (F.col("publication_year").between(1962, 1966), F.col("type") == "t2", F.col("id") == "W012345"):
        found = stored.where(condition).select("id")
        assert {r[0] for r in found.collect()} == {r[0] for r in rows.where(condition).select("id").collect()}
        assert scanned_rows(found) < 10000


def test_rejected_links(spark, world):
    _, settings = world
    links = works_authorship_institutions(read_entity(spark, settings.root, "work"))
    assert {tuple(r) for r in rejected(links, "works_authorship_institutions").collect()} == {("W1", None, "I1")}


def test_clear(spark, world):
    _, settings = world
    run_update(spark, settings, entities=("source",))
    lake = LakeTables(spark, settings.out, 4)
    lake.clear(tables_of("source"))
    assert lake.read(TABLES["sources"]).count() == 0
    assert lake.read(TABLES["sources"]).columns == list(TABLES["sources"].columns)


def test_exports(spark, world, tmp_path):
    _, settings = world
    run_update(spark, settings, entities=("work", "source"))
    lake = LakeTables(spark, settings.out, 4)
    for name in ("works", "sources"):
        spec = TABLES[name]
        write_csv(lake.read(spec).withColumn("dropped", F.lit(1)), spec, str(tmp_path / name))
        back = read_csv(spark, spec, str(tmp_path / name))
        assert sorted(map(str, back.collect())) == sorted(map(str, lake.read(spec).collect()))
    write_json(lake.read(SEARCH_TABLE), str(tmp_path / "json"))
    documents = {d["id"]: d for d in map(json.loads, (r.value for r in spark.read.text(str(tmp_path / "json")).collect()))}
    assert "mag" not in documents["W2"] and documents["W1"]["mag"] == "1"


def test_jdbc(spark, world):
    """An embedded database inside this JVM: no server, no port."""
    _, settings = world
    run_update(spark, settings, entities=("source",))
    rows = LakeTables(spark, settings.out, 4).read(TABLES["sources"]).select("id", "societies", "is_oa")
    url, driver = "jdbc:derby:memory:lake;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    write_jdbc(rows, url, "sources", driver, partitions=1)
    back = spark.read.format("jdbc").option("url", url).option("dbtable", "sources").options(**driver).load()
    assert [tuple(r) for r in back.collect()] == [("S1", "{s t}", None)]


def test_settings(monkeypatch, spark):
    monkeypatch.setenv("LAKE_ROOT", "/in")
    monkeypatch.setenv("LAKE_BUCKETS", "8")
    assert Settings.from_env(out="/out") == Settings("/in", "/out", None, 8)
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_table_specs_cover_every_entity():
    assert len(TABLES) == 18 and {spec.entity for spec in TABLES.values()} == set(ENTITIES)
    assert all(set(s.key) | set(s.not_null) | {s.owner} <= set(s.columns) for s in TABLES.values())
