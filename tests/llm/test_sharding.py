import random

import pytest
from pyspark.sql import functions as F

from scholar_lake.llm import sharding


def check(rows, shards):
    for s in range(shards):
        slots = sorted(r.slot for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_awkward_rows(awkward, nothing):
    rows = sharding.shard_documents(awkward, 3).collect()
    assert len(rows) == awkward.count()
    check(rows, 3)
    for r in rows:
        assert r["size"] == len((r.text or "").encode()) + 1
    assert sharding.shard_documents(nothing, 3).count() == 0


@pytest.mark.parametrize("hot", [0, 1500])
def test_near_equal_bytes_and_groups(spark, hot):
    rng = random.Random(6)
    texts = ["copy " * 10] * hot + [f"{i} " * rng.randint(1, 40) for i in range(3000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = sharding.shard_documents(docs, 8).collect()
    check(rows, 8)
    sizes = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 0.01 * sum(sizes) / 8 + 2 * max(map(len, texts))
    if not hot:
        assert len({r.text for r in rows}) == len({(r.text, r["shard"]) for r in rows})


def test_splitters_are_exact(spark):
    rng = random.Random(7)
    keys = sorted(rng.randrange(-2 ** 63, 2 ** 63) if rng.random() < 0.3 else rng.randrange(1000) for _ in range(2000))
    df = spark.createDataFrame([(k, 10) for k in keys], "shard_key long, size long")
    firsts = sharding.splitters(df, 5, 0.0005)
    for j, first in enumerate(firsts, 1):
        below = sum(10 for k in keys if k < first)
        best = min(abs(sum(10 for k in keys if k < c) - 4000 * j) for c in {*keys, 2 ** 63})
        assert abs(below - 4000 * j) <= max(best, 2)


def test_shard_of_outer_splitters(spark):
    df = spark.range(1).select(sharding.shard_of(F.col("id"), [-2 ** 63, 0, 1, 2 ** 63]).alias("s"))
    assert df.first().s == 2
