import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF
from scholar_lake.functions.text import analyze_query, has_any, tokenize
from scholar_lake.operators import lookups, search
from scholar_lake.operators.cluster import interleave, with_cluster_key
from scholar_lake.operators.dedup import latest_wins, unique_links
from scholar_lake.operators.merge import cascade_delete, delete_by_key, drop_stale, exchange_rows, replace_rows
from scholar_lake.operators.metrics import unprocessed
from scholar_lake.operators.skew import heavy_keys, skew_join
from scholar_lake.schemas import TABLES
from scholar_lake.sources.snapshot import CORRUPT
from scholar_lake.sources.validation import with_wrong_types


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def hot_fact(spark):
    """Key 7 holds about half of the rows."""
    return spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 500).cast("long").alias("k"), F.col("id").alias("v"))


def uneven(spark):
    """Key 7 holds half of the rows, key 8 one in two hundred, the others one each."""
    return spark.range(20000).select(F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 200 == 1, 8).otherwise(F.col("id") + 10)
                                     .cast("long").alias("k"), F.col("id").alias("v"))


def test_heavy_keys(spark):
    assert rows(heavy_keys(hot_fact(spark), "k", 16)) == [(7, 9)]
    assert rows(heavy_keys(uneven(spark), "k", 16)) == [(7, 8)]
    assert rows(heavy_keys(uneven(spark), "k", 1000)) == [(7, 500), (8, 5)]
    assert rows(heavy_keys(spark.range(10000).withColumnRenamed("id", "k"), "k", 16)) == []
    assert rows(heavy_keys(spark.createDataFrame([], "k long"), "k")) == []
    assert rows(heavy_keys(spark.createDataFrame([(None,), (None,)], "k string"), "k")) == []


def test_sketches_do_not_grow_with_the_number_of_tasks(spark):
    assert (7, 502_000) in rows(heavy_keys(hot_fact(spark), "k", 1_000_000))
    fact, dim = uneven(spark), spark.range(0, 20010, 3).select(F.col("id").alias("k"), F.lit("x").alias("d"))
    assert skew_join(fact, dim, "k", tasks=130_000).count() == fact.join(dim, "k").count()


def test_skew_join_equals_plain_join(spark):
    dim = spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") * 3).alias("name"))
    for fact, tasks in ((hot_fact(spark), 16), (uneven(spark), 1000)):
        for how in ("inner", "left", "left_semi", "left_anti"):
            assert rows(skew_join(fact, dim, "k", how, tasks=tasks)) == rows(fact.join(dim, "k", how))


def test_skew_join_keeps_null_keys_of_an_outer_join(spark):
    fact = hot_fact(spark).withColumn("k", F.when(F.col("v") % 5 > 0, F.col("k")))
    dim = spark.range(0, 400).select(F.col("id").alias("k"))
    for how in ("left", "left_anti"):
        assert skew_join(fact, dim, "k", how, tasks=16).count() == fact.join(dim, "k", how).count()


def test_latest_wins_limits_before_the_shuffle(spark):
    newest = latest_wins(hot_fact(spark), ["k"], [F.desc("v")])
    assert rows(newest) == rows(hot_fact(spark).groupBy("k").agg(F.max("v").alias("v")))
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_unique_links(spark):
    links = spark.createDataFrame([("a", "b", 1.0), ("a", "b", 2.0), ("a", "c", None)], "x string, y string, s double")
    assert rows(unique_links(links, ("x", "y")).where("s is not null")) == [("a", "b", 2.0)]
    assert unique_links(links, ("x", "y")).count() == 2
    assert unique_links(links, ()).count() == 3


def test_cascade_delete_deals_by_rows(spark):
    """Rows of a few bytes: by bytes, Spark would give a task all of them."""
    spec = TABLES["works_references"]
    rows = spark.range(0, 40_000).select((F.col("id") % 20_000).cast("string").alias("work_a_id"), F.col("id").cast("string").alias("work_b_id"))
    ids = spark.range(0, 20_000, 2).select(F.col("id").cast("string").alias("id"))
    left = cascade_delete({spec.name: rows}, [spec], ids, 1000)[spec.name]
    most, n = left.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).agg(F.max("n"), F.sum("n")).first()
    assert n == 20_000 and most < 2000
    assert n == cascade_delete({spec.name: rows}, [spec], ids)[spec.name].count()


def test_delete_ignores_nulls(spark):
    target = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    ids = spark.createDataFrame([("a",), (None,), ("a",)], "id string")
    assert sorted(str(r.id) for r in delete_by_key(target, ids, "id").collect()) == ["None", "b"]


def test_replace_is_idempotent_and_inserts_after_deletes(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "id string, n int")
    new = spark.createDataFrame([("b", 2), ("d", 2)], "id string, n int")
    merged = spark.createDataFrame([("c",), ("d",)], "id string")
    once = replace_rows(old, new, "id", deleted=merged)
    assert rows(once) == [("a", 1), ("b", 2), ("d", 2)]
    assert rows(replace_rows(once, new, "id", deleted=merged)) == rows(once)


def test_replace_children_of_a_record_that_lost_them(spark):
    old = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "owner string, n int")
    none = old.where("false")
    changed = spark.createDataFrame([("a",)], "id string")
    for hot in (False, True):
        assert rows(replace_rows(old, none, "owner", changed, hot_owners=hot)) == [("b", 1)]


@pytest.mark.parametrize("hot", [False, True])
def test_exchange_equals_replace(spark, hot):
    old = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1), ("c", 1)] + [("h", n) for n in range(300)], "owner string, n int")
    new = spark.createDataFrame([("b", 2), ("d", 2), ("d", 2), (None, 2)], "n_owner string, n int").withColumnRenamed("n_owner", "owner")
    place = F.pmod(F.xxhash64("owner"), F.lit(3))
    for changed in ([("a",), ("b",), (None,)], [("h",), ("h",), ("b",)], []):
        changed = spark.createDataFrame(changed, "id string")
        deleted = spark.createDataFrame([("d",), ("c",)], "id string")
        got = exchange_rows(old, new, [changed, deleted], "owner", place, 4, hot)
        expected = replace_rows(old, new, "owner", changed, deleted)
        assert sorted(str(tuple(r)) for r in got.drop("_place").collect()) == sorted(str(tuple(r)) for r in expected.collect())
        assert got.where(~F.col("_place").eqNullSafe(place)).isEmpty()


def test_replacing_shuffles_the_target_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = hot_fact(spark)
        changed = spark.range(5, 50).select(F.col("id"))
        plan = exchange_rows(fact, fact.limit(0), [changed], "k", F.pmod(F.xxhash64("k"), F.lit(4)), 2)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
        hot = exchange_rows(fact, fact.limit(0), [changed], "k", F.pmod(F.xxhash64("k"), F.lit(4)), 2, True)
        spread = hot.where("k = 7").groupBy(F.spark_partition_id()).count()
        assert spread.count() > 1 or hot.where("k = 7").isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_drop_stale(spark):
    fresh = spark.createDataFrame([("a", 1), ("b", 5), ("c", 1), ("d", None)], "id string, updated_date int")
    current = spark.createDataFrame([("a", 2), ("b", 2), ("d", 2)], "id string, updated_date int")
    assert sorted(r.id for r in drop_stale(fresh, current).collect()) == ["b", "c", "d"]


def test_unprocessed(spark):
    files = spark.createDataFrame([("x",), ("y",)], "file_path string")
    done = spark.createDataFrame([("x",), ("x",)], "file_path string")
    assert rows(unprocessed(files, done, ["file_path"])) == [("y",)]
    assert rows(unprocessed(files, done, ["file_path"], override=True)) == [("x",), ("y",)]


def collection(spark, n=60):
    rng = random.Random(3)
    texts = [(i, " ".join(rng.choice("to be or not that is the question".split()) for _ in range(rng.randint(0, 30))))
             for i in range(n)]
    return texts, spark.createDataFrame(texts + [(n, None)], "id long, text string")


def test_search_against_brute_force(spark):
    texts, docs = collection(spark)
    index, lengths = search.postings(docs, "text"), search.document_lengths(docs, "text")
    any_of = analyze_query("question that")
    assert [r[0] for r in rows(search.match_any(index, any_of))] == [
        i for i, t in texts if {"question", "that"} & set(t.split())]
    every = analyze_query("to question the to")
    assert [r[0] for r in rows(search.match_all(index, every))] == [
        i for i, t in texts if {"to", "question", "the"} <= set(t.split())]
    phrase = "to be to".split()
    want = [(i, s) for i, t in texts for s in range(len(t.split())) if t.split()[s:s + 3] == phrase]
    assert want and rows(search.match_phrase(index, analyze_query("to be to"))) == want
    for synonyms in ({}, {"question": ["to be", "that is the"]}):
        terms = analyze_query("question not", synonyms=synonyms)
        by_index = [tuple(r) for r in search.bm25(index, lengths, terms, k=10).collect()]
        by_scan = [tuple(r) for r in search.bm25_scan(docs, "text", terms, k=10).collect()]
        assert [i for i, _ in by_index] == [i for i, _ in by_scan]
        assert all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(by_index, by_scan))


def test_scan_ranking_reads_the_texts_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    best = search.bm25_scan(docs, "text", analyze_query("token"), id="doc_id")
    best.collect()
    assert "ReusedExchange" in best._jdf.queryExecution().executedPlan().toString()


def test_phrase_with_synonyms_and_stop_word_gap(spark):
    docs = spark.createDataFrame([(1, "the red car"), (2, "a red the car"), (3, "red auto"), (4, "red motor the vehicle"), (5, "red motor vehicle")],
                                 "id long, text string")
    index = search.postings(docs, "text", stop_words=("the", "a"))
    terms = analyze_query("red car", synonyms={"car": ["auto"]})
    assert rows(search.match_phrase(index, terms)) == [(1, 1), (3, 0)]
    gap = analyze_query("red the car", stop_words=("the", "a"))
    assert rows(search.match_phrase(index, gap)) == [(2, 1)]
    wide = analyze_query("red the car", stop_words=("the",), synonyms={"the car": ["motor vehicle", "motor the vehicle"]})
    assert rows(search.match_phrase(index, wide)) == [(2, 1), (4, 0), (5, 0)]
    said = analyze_query("motor vehicle car", synonyms={"Motor Vehicle": ["the auto"]}, stop_words=("the",))
    assert rows(search.match_any(index, said)) == [(1,), (2,), (3,), (5,)]
    assert rows(docs.where(has_any(tokenize(F.col("text")), said)).select("id")) == [(1,), (2,), (3,), (5,)]
    assert rows(search.match_all(index, analyze_query("red vehicles", synonyms={"vehicles": ["motor vehicle"]}))) == [(5,)]


def test_empty_query_matches_nothing(spark):
    _, docs = collection(spark, 5)
    index = search.postings(docs, "text")
    for match in (search.match_any, search.match_all, search.match_phrase):
        assert match(index, []).count() == 0


def test_facets_and_missing_last(spark):
    hits = spark.createDataFrame([(1, "en"), (2, None), (3, "de")], "id long, lang string")
    assert rows(search.facets(hits, ["lang"])) == [("lang", "de", 1), ("lang", "en", 1)]
    assert [r.id for r in search.sort_missing_last(hits, "lang").collect()] == [3, 1, 2]
    assert [r.id for r in search.sort_missing_last(hits, "lang", descending=True).collect()] == [1, 3, 2]


def test_lookups(spark):
    works = spark.createDataFrame([("W1", "d1", 2000, "en"), ("W2", "d2", 2001, "de"), ("W3", None, None, "en")],
                                  "id string, id_doi string, publication_year int, language string")
    assert [r.id for r in lookups.by_doi(works, "d2", "d9").collect()] == ["W2"]
    assert [r.id for r in lookups.by_year(works, 2000).collect()] == ["W1"]
    assert [r.id for r in lookups.select_works(works, language="en", publication_year=(1999, 2005)).collect()] == ["W1"]
    edges = spark.createDataFrame([("W1", "W2"), ("W2", "W3")], "a string, b string")
    assert rows(lookups.neighbours(edges, "W2", "a", "b")) == [("W1", "in"), ("W3", "out")]


def test_salting_spreads_a_hot_owner(spark):
    """With broadcasting and the merging of small partitions off, no task of the join gets the whole hot key."""
    plain = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in plain.items():
        spark.conf.set(name, value)
    try:
        fact = hot_fact(spark)
        gone = spark.createDataFrame([(i,) for i in range(8, 50)], "id long")
        left = delete_by_key(fact, gone, "k", hot_owners=True)
        assert rows(left) == rows(fact.where("k not between 8 and 49"))
        sizes = left.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 1
    finally:
        for name in plain:
            spark.conf.unset(name)


def brute_window(tokens, words):
    """Width, end and start of the smallest window with all words, the first of equal ones."""
    best = None
    for i in range(len(tokens)):
        for j in range(i, len(tokens)):
            if set(words) <= set(tokens[i:j + 1]):
                best = min(best or (j - i + 1, j, i), (j - i + 1, j, i))
                break
    return best


def test_near_equals_brute_force(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 25))) for _ in range(150)] + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for words, slop in (("a b c", 2), ("a", 0), ("a b a", 4)):
        n, expected = len(set(words.split())), []
        for i, text in enumerate(texts):
            best = brute_window((text or "").split(), words.split())
            if best and best[0] <= n + slop:
                expected.append((i, best[2], best[0]))
        assert rows(search.near(docs, "text", analyze_query(words), slop)) == expected


def test_phrases_in_the_row_equal_votes(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 30))) for _ in range(60)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for query, stops, synonyms in (("a b", (), None), ("a b a", ("b",), None), ("b c", (), {"c": ["a a", "c c"]}), ("a", (), None), ("b", ("b",), None)):
        terms = analyze_query(query, stops, synonyms)
        voted = search.match_phrase(search.postings(docs, "text", stop_words=stops), terms).select("id", "start")
        found = search.phrase_places(docs, "text", terms)
        assert rows(found) == rows(voted)
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_search_over_fields(spark):
    docs = [(1, "fish fish", "about birds"), (2, "birds", "fish and birds and cats"), (3, None, "fish"), (4, "cats", None), (5, None, None)]
    weights, query = {"title": 3.0, "body": 1.0}, ["fish", "birds"]
    fields = {i: {"title": (t or "").split(), "body": (b or "").split()} for i, t, b in docs}
    means = {f: sum(len(d[f]) for d in fields.values()) / len(docs) for f in weights}
    df = {w: sum(any(w in d[f] for f in weights) for d in fields.values()) for w in query}

    def score(doc):
        total = 0
        for w in query:
            x = sum(weights[f] * doc[f].count(w) / (0.25 + 0.75 * len(doc[f]) / means[f]) for f in weights)
            total += math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * x * 2.2 / (x + 1.2)
        return total
    table = spark.createDataFrame(docs, "id long, title string, body string")
    for every in (False, True):
        hits = [i for i, d in fields.items() if (all if every else any)(any(w in d[f] for f in weights) for w in query)]
        expected = sorted(((i, score(fields[i])) for i in hits), key=lambda r: (-r[1], r[0]))
        got = [tuple(r) for r in search.search_fields(table, weights, analyze_query("fish birds"), every=every).collect()]
        assert [i for i, _ in got] == [i for i, _ in expected] and all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(got, expected))


def test_histogram(spark):
    values = spark.createDataFrame([(v, str(v % 3)) for v in (-5, 0, 4, 5, 19, 20, 99)] + [(None, "x")], "v int, kind string")
    got = {(r.part, r.low): (r.n, r.n_distinct) for r in search.histogram(values, "v", 0, 5, 20, "kind").collect()}
    assert got == {("before", None): (1, 1), ("between", 0.0): (2, 2), ("between", 5.0): (1, 1), ("between", 15.0): (1, 1), ("after", None): (2, 2)}


def test_closure_follows_cycles_and_chains(spark, tmp_path):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("x", "x"), ("a", "d"), ("a", "b"), (None, "a"), ("e", None)]
    df = spark.createDataFrame(edges, "s string, t string")
    steps = {}
    for s, t in edges:
        if s and t:
            steps.setdefault(s, set()).add(t)
    expected = []
    for start in steps:
        depth, seen, front = 1, {}, steps[start]
        while front - seen.keys():
            seen.update({n: depth for n in front - seen.keys()})
            front, depth = {t for n in front for t in steps.get(n, ())}, depth + 1
        expected += [(start, n, d) for n, d in seen.items()]
    assert rows(lookups.closure(df, "s", "t", str(tmp_path / "all"))) == sorted(expected)
    assert rows(lookups.closure(df, "s", "t", str(tmp_path / "two"), 2)) == sorted(r for r in expected if r[2] <= 2)
    assert lookups.closure(df.limit(0), "s", "t", str(tmp_path / "none")).count() == 0


def test_cluster_key_against_brute_force(spark):
    """Ranks among quantiles in the columns' order, nulls first; their bits alternate."""
    rows = spark.createDataFrame([(i, None if i % 10 == 0 else f"k{i % 7}") for i in range(64)], "n int, k string")
    assert interleave_of(spark, [(0b101, 0b010), (0b111, 0b000)]) == [0b100110, 0b101010]
    one, other = with_cluster_key(rows, ("n",), "a", 3), with_cluster_key(rows, ("k",), "b", 3)
    got = one.join(other, ["n"]).drop(other["k"]).join(with_cluster_key(rows, ("n", "k"), "c", 3).drop("k"), ["n"]).collect()
    by_n = sorted(got, key=lambda r: r["n"])
    assert [r["a"] for r in by_n] == sorted(r["a"] for r in by_n) and len({r["a"] for r in by_n}) == 8
    assert {r["b"] for r in got if r["k"] is None} == {0}
    with_k = sorted((r for r in got if r["k"]), key=lambda r: r["k"])
    assert [r["b"] for r in with_k] == sorted(r["b"] for r in with_k)
    for r in got:
        assert r["c"] == sum((r["a"] >> i & 1) << (2 * i + 1) | (r["b"] >> i & 1) << (2 * i) for i in range(3))
    nothing = rows.limit(0)
    assert with_cluster_key(nothing, ("n", "k")).collect() == []


def interleave_of(spark, pairs):
    return [r[0] for r in spark.createDataFrame(pairs, "a int, b int").select(interleave([F.col("a"), F.col("b")], 3)).collect()]


def test_wrong_types(spark):
    """Paths in lists and structs; text takes anything, nulls and absent fields are right; whole numbers in decimals are."""
    lines = ['{"id": 5, "geo": {"latitude": 3, "city": 4}, "cited_by_count": null}', '{"counts_by_year": [{"year": 1}, {"year": "x"}], "geo": [1]}',
             "[1]", "{", None, '{"cited_by_count": 1.5, "international": 3}']
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], f"n int, {CORRUPT} string")
    got = [r["wrong_types"] for r in with_wrong_types(rows, "institution").orderBy("n").collect()]
    assert got[:5] == ["", "counts_by_year[].year,geo", "record", "no JSON", None] and got[5].startswith("cited_by_count")
    assert with_wrong_types(rows.select("n"), "institution").where("wrong_types is not null").isEmpty()
