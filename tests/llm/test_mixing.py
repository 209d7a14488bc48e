import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scholar_lake.llm import mixing


def water(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by resharing round after round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        left, heavy = total - sum(capped.values()), sum(weight[s] for s in rest)
        now = {s: left * weight[s] / heavy for s in rest}
        over = [s for s in rest if now[s] > most * sizes[s] + 1e-9]
        if not over:
            return capped | now
        capped |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, None: 50, "Z": 7}, {"é": 3, "z": 10, None: 0}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.mix_source: r.mix_target for r in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(water(sizes))


def test_plan_and_mix(awkward, nothing):
    rows = mixing.plan_mix(awkward).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) and 0 <= r.copies <= 2
    mixed = mixing.mix(awkward)
    assert mixed.columns == awkward.columns
    expected = Counter()
    for r in rows:
        expected[r.doc_id, r.text] += r.copies
    assert Counter((r.doc_id, r.text) for r in mixed.collect()) == +expected
    assert mixing.plan_mix(nothing).count() == mixing.mix(nothing).count() == 0


def test_taken_is_near_target(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 4).alias("source"),
                                    F.repeat(F.lit("w "), (F.col("id") % 50).cast("int") + 1).alias("text"))
    got = mixing.plan_mix(docs).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"))
    assert all(abs(r.taken / r.target - 1) < 0.06 for r in got.collect())
