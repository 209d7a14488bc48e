import math
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF
from scholar_lake.llm import arrays, ppm


def tree(texts):
    counts = [defaultdict(Counter) for _ in range(4)]
    for text in texts:
        b = b"\n\n\n" + text.encode()
        for i in range(3, len(b)):
            for k in range(4):
                counts[k][b[i - k:i]][b[i]] += 1
    return counts


def bits(counts, text):
    b, total = b"\n\n\n" + text.encode(), 0.0
    for i in range(3, len(b)):
        gone = set()
        for k in (3, 2, 1, 0):
            known = counts[k].get(b[i - k:i], {})
            left = {s: n for s, n in known.items() if s not in gone}
            if left:
                some = sum(left.values()) + len(left)
                if b[i] in left:
                    total -= math.log2(left[b[i]] / some)
                    break
                total -= math.log2(len(left) / some)
            gone |= set(known)
        else:
            total += math.log2(256 - len(gone))
    return total


def test_code_lengths_match_a_walk_of_the_trees():
    rng = random.Random(1)
    samples = {"x": ["abab abba é"] * 2 + ["".join(rng.choice("abc é") for _ in range(300))], "y": ["zyx zz", ""]}
    model = ppm.Model.learn(samples)
    texts = ["abab", "", None, "zyxw é\n", "".join(rng.choice("abcxyz é") for _ in range(500))]
    got = model.code_lengths(*arrays.flat(pa.array(texts, pa.string())))
    for i, text in enumerate(texts):
        for j, language in enumerate(model.languages):
            assert got[i, j] == pytest.approx(bits(tree(samples[language]), text or ""))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF.replace("sf0.001", "sf0.01") + "/documents.parquet").withColumn("held_out", ppm.held_out(F.col("doc_id")))
    judged = ppm.predict(docs, ppm.learn(docs.where("NOT held_out")), "lang", "held_out").where("held_out")
    right = judged.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.97


def test_awkward_rows(awkward, nothing):
    model = ppm.learn(awkward)
    rows = ppm.predict(awkward, model, "doc_id", "text", "size").collect()
    assert len(rows) == awkward.count() and {r.size for r in rows} == {"theirs"}
    for r in rows:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.text is None or not any(c.isalpha() for c in r.text))
    assert ppm.predict(nothing, ppm.learn(nothing), "doc_id").count() == 0
    assert {r.lang_pred for r in ppm.predict(awkward, ppm.learn(nothing), "doc_id").collect()} == {"und"}


def test_a_language_of_long_texts_only_is_learnt(spark):
    rows = [(i, "ab ba " * 40_000 + str(i), "x") for i in range(3)] + [(10 + i, f"yz zy {i}", "y") for i in range(3)]
    model = ppm.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["x", "y"]
    asked = spark.createDataFrame([("ab ba ab",), ("zy yz zy",)], "text string")
    assert {r.text: r.lang_pred for r in ppm.predict(asked, model, "text").collect()} == {"ab ba ab": "x", "zy yz zy": "y"}
