import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from scholar_lake.functions.abstracts import abstract_text, build_index, read_index, rebuild_abstract
from scholar_lake.functions.casting import empty_as_null, typed_load
from scholar_lake.functions.documents import apc_value, biblio_json, grants_json, is_primary, title_abstract
from scholar_lake.functions.ids import partition_label, strip_id
from scholar_lake.functions.lists import array_literal, clean_list, list_literal, parse_literal, society_names, unique_items
from scholar_lake.functions.text import analyze_query, drop_stop_words, has_any, tokenize, tokenize_words

P = "https://scholar.test/"


def values(spark, rows, ddl, column):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {ddl}")
            .select("i", column(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_strip_id(spark):
    given_ids = [None, "", P[:20], P, P + "W12"]
    assert values(spark, given_ids, "string", strip_id) == [None, None, None, "", "W12"]


def test_partition_label(spark):
    assert values(spark, ["file:///a/data/works/updated_date=2023-05-01/part_000.gz"], "string", partition_label) == [
        "2023-05-01-part_000"]


def test_clean_list(spark):
    rows = [None, [], [None, ""], ["a,b", "c'd"], ['"']]
    assert values(spark, rows, "array<string>", clean_list) == [None, None, None, ["ab", "cd"], [""]]
    assert values(spark, rows, "array<string>", lambda c: list_literal(clean_list(c))) == [
        None, None, None, "{ab,cd}", "{}"]


def test_clean_list_strips_ids_and_drops_short_items(spark):
    rows = [["short", P + "P1", None, P + "P,2"], ["short"]]
    assert values(spark, rows, "array<string>", lambda c: clean_list(c, strip=True)) == [["P1", "P2"], None]


def test_society_names(spark):
    rows = [[("u", "A, B"), ("u", None)], None]
    assert values(spark, rows, "array<struct<url:string,organization:string>>", society_names) == [["A B"], None]


def test_unique_items_keeps_the_greatest_of_each_key(spark):
    rows = [[("b", 1.0), ("a", 2.0), ("b", 3.0), (None, 1.0), ("a", None)], [], None]
    kept = values(spark, rows, "array<struct<id:string,score:double>>", lambda c: unique_items(c, ["id"]))
    assert [None if k is None else [tuple(x) for x in k] for k in kept] == [
        [(None, 1.0), ("a", 2.0), ("b", 3.0)], [], None]


INDEXES = [
    ({"b": [1], "a": [0, 2]}, "a b a"),
    ({"a": [0], "b": [2]}, "a "),                 # two slots, position 2 is dropped
    ({"a": [0, 1], "b": [1]}, "a b "),            # clash: the later token wins; the third slot is empty
    ({"a": [2], "b": [2], "c": [2]}, "  c"),
    ({"a": [5]}, ""),
    ({"a": [-1, 0]}, "a "),
    ({"x": []}, ""),
    ({}, ""),
    (None, None),
]


def from_json_text(raw):
    return rebuild_abstract(read_index(raw))


def test_rebuild_abstract(spark):
    got = values(spark, [None if i is None else json.dumps(i) for i, _ in INDEXES], "string", from_json_text)
    assert got == [text for _, text in INDEXES]


def test_abstract_text_shapes_and_blanks(spark):
    rows = ['{"b":[1],"a":[0,2]}', '{"IndexLength":3,"InvertedIndex":{"b":[1],"a":[0,2]}}', "{}",
            '{"\\u00a0":[0],"\\t":[1]}', "no json", None, '{"InvertedIndex":[0],"is":[1]}']
    assert values(spark, rows, "string", abstract_text) == ["a b a", "a b a", None, None, None, None, "InvertedIndex is"]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.text(min_size=1, max_size=4), max_size=12), min_size=10, max_size=30))
def test_rebuild_inverts_build(spark, texts):
    got = values(spark, texts, "array<string>", lambda c: rebuild_abstract(build_index(c)))
    assert got == [" ".join(t) if t else None for t in texts]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.text(min_size=1, max_size=2), st.lists(st.integers(0, 9), max_size=4), max_size=5),
                min_size=10, max_size=30))
def test_rebuild_agrees_with_slots(spark, indexes):
    def brute(index):
        slots = [""] * sum(map(len, index.values()))
        for token, positions in index.items():
            for p in positions:
                if p < len(slots):
                    slots[p] = token
        return " ".join(slots)
    assert values(spark, [json.dumps(i) for i in indexes], "string", from_json_text) == [brute(i) for i in indexes]


def test_title_abstract(spark):
    rows = spark.createDataFrame([("t", "a"), ("t", None), (None, "a"), (None, None)], "t string, a string")
    assert [r[0] for r in rows.select(title_abstract(F.col("t"), F.col("a"))).collect()] == ["t a", "t ", " a", None]


def test_grants_json(spark):
    rows = [[(P + "F1", None, "x")], [], None]
    kind = "array<struct<funder:string,funder_display_name:string,award_id:string>>"
    assert values(spark, rows, kind, grants_json) == [
        '[{"funder":"F1","funder_display_name":null,"award_id":"x"}]', None, None]


def test_apc_value(spark):
    assert values(spark, ['{"value_usd":7}', '[{"value_usd":7}]', None, '{"value":1}'], "string", apc_value) == [
        7, None, None, None]


def test_biblio_json_needs_a_volume(spark):
    assert values(spark, [("1", None), (None, "2"), None], "struct<volume:string,issue:string>", biblio_json) == [
        '{"volume":"1"}', None, None]


def test_is_primary(spark):
    place = "struct<source:struct<id:string,display_name:string>,pdf_url:string,version:string>"
    source = ("s", "S")
    rows = [((source, None, "v"), (source, None, "v"), True), ((source, "x", "v"), (source, None, "v"), False),
            ((None, None, "v"), (None, None, "v"), False), (None, (source, None, "v"), False),
            ((source, None, "v"), (("s", "T"), None, "v"), False), ((("s", None), None, None), (("s", None), None, None), True)]
    df = spark.createDataFrame(rows, f"p {place}, x {place}, want boolean")
    assert all(r[0] == r[1] for r in df.select(
        F.coalesce(is_primary(F.col("p"), F.col("x")), F.lit(False)), "want").collect())


def test_tokens_and_queries(spark):
    text = ["The Quick-brown FOX, école 42!", None]
    assert values(spark, text, "string", tokenize) == [["the", "quick", "brown", "fox", "école", "42"], None]
    assert values(spark, text, "string", lambda c: drop_stop_words(tokenize(c), ["The"]))[0][0] == "quick"
    terms = analyze_query("The FOX École", stop_words=["the"], synonyms={"fox": ["Vixen", "red the dog"]})
    assert [(t.offset, t.width, [(f.width, f.words) for f in t.forms]) for t in terms] == [
        (1, 1, [(1, ((0, "fox"),)), (1, ((0, "vixen"),)), (3, ((0, "red"), (2, "dog")))]), (2, 1, [(1, ((0, "école"),))])]
    for query, found in (("cat dog", False), ("cat 42", True), ("quick", True)):
        assert values(spark, text[:1], "string", lambda c: has_any(tokenize(c), analyze_query(query))) == [found]


def test_empty_as_null_and_typed_load(spark):
    df = spark.createDataFrame([("", "1", "2024-01-01"), ("a", "x", "2024-01-01"), ("b", None, "y")], "t string, n string, d string")
    assert [r.t for r in empty_as_null(df).collect()] == [None, "a", "b"]
    good, rejects = typed_load(df, {"n": "int", "d": "date"})
    assert [r.n for r in good.collect()] == [1]
    assert sorted(r.reject_reason for r in rejects.collect()) == ["d", "n"]


@pytest.mark.parametrize("text, tokens", [
    ("The quick (“brown”) fox can’t jump 32.3 feet, right?", "the quick brown fox can’t jump 32.3 feet right"),
    ("don't 'quoted' o'clock' x.y.z end.", "don't quoted o'clock x.y.z end"), ("1,000.5 a,b 3,a 1. .5", "1,000.5 a b 3 a 1 5"),
    ("snake_case __init__ a_1 _ __", "snake_case __init__ a_1"), ("abc123 4g e.2", "abc123 4g e 2"),
    ("日本語 です カタカナ テスト", "日 本 語 で す カタカナ テスト"), ("한국어 단어", "한국어 단어"), ("naïve cafe\u0301s", "naïve cafe\u0301s"), ("a\u00ADb", "a\u00ADb"),
    ("user@example.com and/or", "user example.com and or"), ("ÉTÉ", "été"), ("", ""), (" .,;!", "")])
def test_word_breaks(spark, text, tokens):
    got = spark.createDataFrame([(text,)], "t string").select(tokenize_words(F.col("t"))).first()[0]
    assert got == tokens.split(" ") if tokens else got == []


def test_word_breaks_take_linear_time(spark):
    long = spark.range(1).select(F.repeat(F.lit("a.b'c_1,2."), 200_000).alias("t"))
    assert long.select(F.size(tokenize_words(F.col("t")))).first()[0] > 0


def test_array_literals(spark):
    lists = [["a", "b"], [], None, [""], [None], ["null", "NULL", None], ["a,b", "{c}", 'd"e', "f\\g", " h ", "i j", "\n", "ü", "\\"], ['"', '""', "{}", ","]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "id int, x array<string>")
    back = df.select("id", parse_literal(array_literal(F.col("x"))).alias("x")).orderBy("id").collect()
    assert [r.x for r in back] == lists


def test_array_literals_quote_only_where_needed(spark):
    df = spark.createDataFrame([(["i j", " h", "h ", "a\tb\nc", "a\n"],)], "x array<string>")
    assert df.select(array_literal(F.col("x"))).first()[0] == '{i j," h","h ",a\tb\nc,"a\n"}'
    assert df.select(parse_literal(array_literal(F.col("x")))).first()[0] == ["i j", " h", "h ", "a\tb\nc", "a\n"]


@pytest.mark.parametrize("text, items", [
    ("{a,b}", ["a", "b"]), ("{}", []), (" { a , b } ", ["a", "b"]), ('{"a,b",NULL,"NULL",c d}', ["a,b", None, "NULL", "c d"]), ("{a", None), ("a,b", None),
    ("{a,}", None), ("{,}", None), ('{"a}', None), ('{"a""b"}', None), (None, None), ("{{a,b},{c}}", ["{a,b}", "{c}"]), ('{{"x,}",y},{}}', ['{"x,}",y}', "{}"])])
def test_parse_literal(spark, text, items):
    assert spark.createDataFrame([(text,)], "t string").select(parse_literal(F.col("t"))).first()[0] == items
