import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    folder = tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out.append((name, docs, after))
        docs = after
    return out


def test_columns_and_order(stages, spark):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [name for name, _, _ in stages] == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]
    assert all(after.columns == columns for _, _, after in stages[:-1])
    assert stages[-1][2].columns == [*columns, "size", "shard", "slot"]


def test_each_stage_decides(stages):
    before = {name: b.count() for name, b, _ in stages}
    after = {name: a.count() for name, _, a in stages}
    assert 0.95 * before["language_id"] <= after["language_id"] <= before["language_id"]
    for name in ("near_dedup", "decontamination"):
        assert 0.5 * before[name] < after[name] < before[name]
    assert after["mixing"] > before["mixing"] and after["sharding"] == before["sharding"]


def test_no_equal_texts_and_no_test_items_are_left(stages, spark):
    kept = stages[2][2]
    assert kept.select("text").distinct().count() == kept.count()
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = [r.text for r in kept.select("text").collect()]
    assert not any(i in t for i in items for t in texts)


def test_run_is_repeatable(spark):
    def rows():
        return sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "shard", "slot").collect())
    assert rows() == rows()


def test_awkward_and_empty(spark, awkward, nothing):
    for docs in (awkward.drop("size"), nothing):
        for name, stage in corpus_pipeline.STAGES:
            rows = stage(spark, docs, SF).count()
            assert rows <= 2 * docs.count()
    left = corpus_pipeline.near_dedup(spark, awkward, SF)
    assert left.columns == awkward.columns
    assert sorted(r.doc_id for r in left.collect()) == [0, 2, 3, 6, 7, 8, 9, 10, 10, 11]  # 2 differs from 0 in more than 3 bits
