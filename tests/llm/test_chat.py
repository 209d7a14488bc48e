import json

from pyspark.sql import functions as F

from scholar_lake.llm import chat


def test_layouts_are_told_apart(spark):
    records = [
        {"prompt": "p", "completion": "c"}, {"completion": "c", "prompt": None}, {"instruction": "i", "input": "n", "output": 5},
        {"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "assistant"}]}, {"messages": []}, {"messages": None},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, {"prompt": "p", "completion": "c", "more": 1},
        {"data": {"messages": [{"role": "system", "content": "s"}]}},
    ]
    texts = [json.dumps(r) for r in records] + [None, "no json", "3"]
    rows = chat.turns_of_records(spark.createDataFrame(list(enumerate(texts)), "conv_id long, record string"), "record").orderBy("conv_id").collect()
    assert [r.layout for r in rows] == ["prompt", "prompt", "instruction_input", "messages", None, None, "from_value", "prompt", "nested_messages",
                                       None, None, None]
    assert [tuple(t) for t in rows[2].turns] == [("user", "i"), ("user", "n"), ("assistant", "5")]
    assert [tuple(t) for t in rows[6].turns] == [("user", "a"), ("assistant", "b")]
    assert [tuple(t) for t in rows[1].turns] == [("user", ""), ("assistant", "c")] and rows[4].turns == []
    canonical = chat.turns_of_table(spark.createDataFrame([(1, json.dumps(records[3]))], "conv_id long, record string")
                                    .transform(lambda d: chat.turns_of_records(d, "record")))
    assert [tuple(r) for r in canonical.orderBy("ordinal").collect()] == [(1, 0, "user", "a"), (1, 1, "assistant", "b")]


def test_round_trip(spark):
    texts = ["", None, r"\### Assistant: </turn> ok", "</turn>\n### user: x", "\\l\\h\\b\\c\\", "a: b", "é<#\\:\n", "\\", "\U0001F600 </turn>\n"]
    rows = [(c, t, ["user", "assistant", None, "we: ird</turn>\n"][(c + t) % 4], texts[(c * 3 + t) % len(texts)]) for c in range(12) for t in range(c)]
    rows += [(None, 0, "assistant", "n"), (None, 0, "assistant", "m"), (50, None, "user", "first"), (50, 3, "assistant", "last")]
    turns = chat.turns_of_table(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    chats = chat.format_chats(turns)
    got = {r.conv_id: r for r in chats.select("conv_id", "formatted", "loss_spans", chat.read_back(F.col("formatted")).alias("turns"),
                                              chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("learnt")).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        own = sorted(((t if t is not None else -1), role or "", text or "") for c, t, role, text in rows if c == conv)
        assert [tuple(t) for t in r.turns] == [(role, text) for _, role, text in own]
        assert r.learnt == "".join(text for _, role, text in own if role == "assistant")
        assert all(chat.END not in r.formatted[s.start:s.start + s.length] for s in r.loss_spans)
    assert chat.format_chats(turns.where("false")).count() == 0


def test_fields_outside_the_layouts_are_not_looked_at(spark):
    records = [
        {"id": 7, "conversations": [{"from": "human", "value": "a", "weight": 0}, {"from": "gpt", "value": "b"}], "system_hint": {"prompt": "x"}},
        {"messages": [{"role": "user", "content": "a", "name": "n", "meta": {"value": 1}}], "data": {"source": "s"}},
        {"prompt": "p", "completion": "c", "answer": "two layouts at once"}, {"prompt": "p"}, {"messages": [1, "text"]}, {"meta": {"messages": []}},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "conv_id long, record string")
    mapped = chat.turns_of_records(df, "record")
    rows = mapped.orderBy("conv_id").collect()
    assert [r.layout for r in rows] == ["from_value", "messages", None, None, None, None]
    assert [tuple(t) for t in rows[0].turns] == [("user", "a"), ("assistant", "b")] and [tuple(t) for t in rows[1].turns] == [("user", "a")]
    left = chat.rejects(mapped)
    assert left.columns == df.columns and sorted(r.conv_id for r in left.collect()) == [2, 3, 4, 5]


def test_turns_through_records_of_all_layouts(spark):
    texts = ["", r"\### Assistant: </turn> ok", '"quoted" \\ {"role": 1}', "é\n\t\u0001\U0001F600", "5", "null"]
    roles = [["user", "assistant"], ["user", "user", "assistant"], ["system", "user", "assistant"], ["user"] * 3, ["user", "assistant"] * 9, ["human", "bot"],
             ["", "we: ird"]]
    rows = [(c if c else None, t, role, texts[(c * 5 + t) % 6]) for c in range(140) for t, role in enumerate(roles[c % 7])]
    rows += [(1000, 0, "user", "x" * (chat.LARGEST + 1)), (1000, 1, "assistant", "y")]
    turns = chat.turns_of_table(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    records = chat.records_of_turns(turns)
    used = {r.layout for r in chat.turns_of_records(records, "record").where("rest IS NULL").collect()}
    assert used == set(chat.LAYOUTS)
    assert records.where("rest IS NOT NULL").select("conv_id").distinct().count() == 21 and records.where("rest IS NULL AND record IS NULL").count() == 0
    back = chat.through_records(turns)
    assert sorted(map(str, back.collect())) == sorted(map(str, turns.select(back.columns).collect()))
    assert chat.through_records(turns.where("false")).count() == 0


def test_a_layout_of_ones_own(spark):
    layouts = {"dialogue": ("$.log.lines", "$.who", "$.said"), "pair": [("user", "$.q"), ("assistant", "$.a")]}
    turns = spark.createDataFrame([(c, t, "user", f"{c}{t}") for c in range(5) for t in range(c)] + [(9, 0, "user", "q"), (9, 1, "assistant", "a")],
                                  "conv_id long, ordinal long, role string, text string")
    records = chat.turns_of_records(chat.records_of_turns(turns, layouts), "record", layouts)
    assert {r.layout for r in records.collect()} == set(layouts)
    assert sorted(map(tuple, chat.turns_of_table(records).collect())) == sorted(map(tuple, turns.collect()))
    assert set(chat.turns_of_records(records.select("conv_id", "record"), "record").select("layout").distinct().toPandas()["layout"]) == {None}


def test_other_columns_are_not_looked_at(spark):
    rows = [(1, 0, "user", "a", [1], "x"), (1, 1, "assistant", "b", None, "y")]
    turns = chat.turns_of_table(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted array<int>, chat_head string"))
    assert [tuple(r) for r in turns.orderBy("ordinal").collect()] == [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
