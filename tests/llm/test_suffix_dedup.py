import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scholar_lake.llm import arrays, suffix_dedup


def brute(texts, length):
    """n_bytes, n_removed, n_spans and digest of each text."""
    blobs = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in blobs for i in range(len(b) - length + 1))
    out = []
    for b in blobs:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        edges = np.diff(np.concatenate(([0], gone.astype(int))))
        out.append((len(b), len(b) - len(kept), int((edges > 0).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(rng, kinds):
    alphabet = "abé \n" if kinds == "dense" else "abcdefghijklmnopqrstuvwxyz  "
    fresh = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    shared = [fresh(rng.randint(30, 160)) for _ in range(4)]
    texts = [None, "", "a" * 300, "a" * 39, "ab" * 100, fresh(39), fresh(40)]
    for _ in range(60):
        texts.append("".join(rng.choice([fresh(rng.randint(1, 60)), rng.choice(shared), rng.choice(shared)[rng.randint(0, 20):]])
                             for _ in range(rng.randint(1, 6))))
    return texts + texts[20:26] + [shared[0], shared[0][:40], fresh(20) + shared[1][5:50]]


@pytest.mark.parametrize("kinds", ["dense", "letters"])
@pytest.mark.parametrize("hot", [0, 400])
def test_matches_brute_force(spark, kinds, hot):
    rng = random.Random(len(kinds) + hot)
    texts = corpus(rng, kinds)
    passage = "".join(rng.choice("pqrstuv") for _ in range(70))
    texts += ["".join(rng.choice("klmno") for _ in range(rng.randint(0, 30))) + passage + str(rng.random())[:rng.randint(2, 12)] for _ in range(hot)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("key", F.lit("theirs"))
    rows = suffix_dedup.remove_duplicates(docs, 40, 18).collect()
    expected = brute(texts, 40)
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id], texts[r.doc_id]
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256


@pytest.mark.parametrize("parts", [3, 11])
def test_results_do_not_depend_on_reused_exchanges(spark, parts):
    """Bucket bounds are sampled; what is derived from them must not come from a second sample."""
    texts = corpus(random.Random(parts), "dense")
    before = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.exchange.reuse", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        rows = suffix_dedup.remove_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 40, 18).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    expected = brute(texts, 40)
    assert [tuple(r)[1:5] for r in sorted(rows)] == expected


def test_awkward_rows(awkward, nothing):
    rows = suffix_dedup.remove_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    texts = [r.text for r in awkward.collect()]
    assert sorted(tuple(r)[1:5] for r in rows) == sorted(brute(texts, 400))
    assert suffix_dedup.remove_duplicates(nothing).count() == 0


def test_every_string_has_one_anchor_that_its_content_decides():
    rng = np.random.default_rng(3)
    data = np.frombuffer(bytes(rng.integers(97, 100, 900, np.uint8)) * 2, np.uint8)
    text, anchor, first, last = suffix_dedup.anchors(data, np.array([0, 900, 900, 1800]), 60, 20)
    own = {}
    for t, a, i, j in zip(text, anchor, first, last):
        for s in range(i, j + 1):
            assert s <= a <= s + 40 and own.setdefault((t, s), a - s) == a - s
    assert sorted(s for _, s in own) == [*range(0, 841), *range(900, 1741)]
    assert all(own[0, s] == own[2, s + 900] for s in range(841))


def test_hashes_depend_on_content_alone():
    data = np.frombuffer(b"xxabcabcabcyyabcabcabc", np.uint8)
    rolling = suffix_dedup.RollingHash(data)
    a, b = rolling.of(np.array([2, 13, 3]), np.array([11, 22, 12]))[[0, 1]]
    assert a == b != rolling.of(np.array([3]), np.array([12]))[0]
    assert arrays.flat(pa.array(["é", None, ""]))[1].tolist() == [0, 2, 2, 2]
