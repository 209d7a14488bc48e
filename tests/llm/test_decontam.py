import random

import numpy as np
import pytest

from scholar_lake.llm import decontam


def smith_waterman(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(max(0, last[j] + (2 if x == y else -1), last[j + 1] - 1, row[-1] - 1))
        best = max(best, *row)
    return best


def test_alignment_matches_the_textbook():
    rng = np.random.default_rng(4)
    a, b = rng.integers(10, 15, (40, 12)).astype(np.uint64), rng.integers(10, 15, (40, 30)).astype(np.uint64)
    a[3, 7:], b[5, 20:] = 0, 1  # padding
    best, _ = decontam.align(a, b)
    for i in range(40):
        assert best[i] == smith_waterman([x for x in a[i] if x], [y for y in b[i] if y != 1])


def vocabulary(rng, n):
    return ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 8))) for _ in range(n)]


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(8)
    common, words = vocabulary(rng, 8), vocabulary(rng, 600)
    say = lambda n: [rng.choice(common if rng.random() < 0.5 else words) for _ in range(n)]
    items = [(i, " ".join(say(rng.randint(14, 50)))) for i in range(40)] + [(90, None), (91, ""), (92, "too short"), (93, "Items, equal items: one TWO three four")]
    docs, expected = [], set()
    for d in range(300):
        text = say(rng.randint(30, 400))
        if d % 3 == 0:
            i = rng.randrange(40)
            copy = items[i][1].split()
            for k in rng.sample(range(len(copy)), len(copy) // 10 if d % 2 else 0):
                copy[k] = rng.choice(words)
            at = rng.randrange(len(text))
            text[at:at] = copy
            expected.add((d, i))
        docs.append((d, " ".join(text)))
    docs += [(400, None), (401, ""), (402, "x items equal ITEMS one two three four y"), (402, "x items equal ITEMS one two three four y")]
    return (spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", __import__("pyspark").sql.functions.lit("theirs")),
            spark.createDataFrame(items, "item_id long, text string"), expected | {(402, 93)})


@pytest.mark.parametrize("block_bytes", [8_000_000, 1_500])
def test_planted_copies_are_found_and_nothing_else(planted, block_bytes):
    docs, items, expected = planted
    rows = decontam.find_leaks(docs, items, block_bytes=block_bytes).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == expected and len(rows) == len(expected) + 1
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert 0.5 <= r.score <= 1 and 0 <= r.first_word <= r.last_word < len(texts[r.doc_id].split())
    kept = decontam.clean(docs, items, block_bytes=block_bytes)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(texts) - {d for d, _ in expected})


def test_empty_sides(spark, awkward, nothing, planted):
    _, items, _ = planted
    none = items.where("false")
    assert decontam.find_leaks(awkward, none).count() == decontam.find_leaks(nothing, items).count() == 0
    assert decontam.clean(awkward, none).count() == awkward.count() and decontam.clean(nothing, items).count() == 0
    assert decontam.clean(awkward, items).count() == awkward.count()


def reported(spark, docs, items):
    rows = decontam.find_leaks(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"),
                               spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    return {(r.doc_id, r.item_id) for r in rows}


def test_short_items_need_nearly_all_of_their_words(spark):
    items = ["who won it", "where is the sea", "how do you do today", "what is the capital of france", "what is the point of this whole",
             "once upon a time there was a king"]
    common = ["what is the time and where is the key", "how do you do it what is the capital idea", "this is the point of no return who won",
              "once upon a time there lived an old queen", "what is the point of it and where is the harbour"]
    copies = ["tell me who won it then", "oh where is the sea now", "well how do you do today sir", "so what is the capital of spain",
              "then what was the point of this whole thing", "once upon a time there was one king"]
    assert reported(spark, common * 20 + copies, items) == {(100 + i, i) for i in range(len(items))}


def test_partial_copies_of_long_items(spark):
    rng = random.Random(11)
    words = vocabulary(rng, 3000)
    say = lambda n: [rng.choice(words) for _ in range(n)]
    items = [say(400), say(300), say(500)]
    edited = items[2][200:300]
    for k in range(5, 100, 12):
        edited[k] = "changed"
    docs = [say(80) + items[0][150:340] + say(60), items[1][120:220], say(300) + edited + say(10), say(40) + items[0][-30:], items[1][:31] + say(900)]
    expected = {(0, 0), (1, 1), (2, 2), (3, 0), (4, 1)}
    clean = [say(600), items[0][:24] + say(200), [w for x in items[2][:120] for w in (x, rng.choice(words), rng.choice(words))]]
    # a passage that many documents hold keeps its seeds
    docs, expected = docs + clean + [say(50) + items[1][40:75] for _ in range(60)], expected | {(8 + i, 1) for i in range(60)}
    rows = decontam.find_leaks(spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string"),
                               spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == expected
    at = {r.doc_id: (r.first_word, r.last_word) for r in rows}
    assert at[0][0] <= 80 and at[0][1] >= 269 and at[1] == (0, 99) and at[3][0] <= 40 and at[3][1] == 69


def test_against_full_alignment_of_all_pairs(spark):
    """Every document with every item, without seeds and windows: nothing more may be reported, and at most one in fifty is missed."""
    rng = random.Random(21)
    common, words = vocabulary(rng, 10), vocabulary(rng, 400)
    say = lambda n: [rng.choice(common if rng.random() < 0.5 else words) for _ in range(n)]
    items = [say(rng.randint(3, 45)) for _ in range(25)]
    docs = []
    for d in range(150):
        copy = []
        for word in items[d % 25]:  # a copy with up to a third of its words changed, left out or followed by others
            kind = rng.random() / (d // 25 * 0.07 or 0.001)
            copy += [rng.choice(words)] if kind < 0.4 else [] if kind < 0.7 else [word, rng.choice(common)] if kind < 1 else [word]
        docs.append(say(rng.randint(0, 60)) + copy + say(rng.randint(0, 60)))
    expected = {(d, i) for d, text in enumerate(docs) for i, item in enumerate(items)
                if smith_waterman(item, text) >= decontam.least_score(np.array([len(item)]), 0.5)[0]}
    found = reported(spark, [" ".join(d) for d in docs], [" ".join(i) for i in items])
    print(f"{len(found)} of {len(expected)} pairs")
    assert found <= expected and len(expected) > 100 and len(found) >= 0.98 * len(expected)


def test_long_items_are_aligned_in_bounded_memory(monkeypatch):
    widths = np.array([5, 5, 6, 1000, 1 << 20, 1 << 22, 3])
    for pairs in (1, 2, 512):
        monkeypatch.setattr(decontam, "PAIRS_AT_ONCE", pairs)
        runs = list(decontam.aligned_together(widths))
        assert [i for r in runs for i in range(r.start, r.stop)] == list(range(7))
        assert all(r.stop - r.start <= pairs and (r.stop - r.start == 1 or (r.stop - r.start) * widths[r].max() <= decontam.PADDED_WORDS) for r in runs)
    rng = np.random.default_rng(2)
    words = rng.integers(10, 1000, 3000).astype(np.uint64)
    items = decontam.Items(np.arange(2), words, np.array([0, 1500, 3000]), *decontam.Items.index(*decontam.ngrams(words, np.array([0, 1500, 3000])),
                                                                                           np.array([0, 1500, 3000])))
    whole = decontam.leaks(words, np.array([0, 1500, 3000]), items, 0.5)
    monkeypatch.setattr(decontam, "PADDED_WORDS", 1)
    alone = decontam.leaks(words, np.array([0, 1500, 3000]), items, 0.5)
    assert all(np.array_equal(a, b) for a, b in zip(whole, alone)) and list(whole[0]) == [0, 1]
