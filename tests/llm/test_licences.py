import random
import re

from pyspark.sql import functions as F

from scholar_lake.llm import licences


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base(text):
    words, places = words_of(text), []
    for phrase, label in licences.PHRASES.items():
        own = phrase.split()
        places += [(i, label) for i in range(len(words) - len(own) + 1) if words[i:i + len(own)] == own]
    return sorted(places)


def test_phrases_match_brute_force(spark):
    rng = random.Random(9)
    pool = "under the mit license apache version 2 cc by nc é ÉTÉ the UNDER Mit x1".split()
    texts = [None, "", "cc", "CC-BY-NC", "under the mit license" * 2, "under the mKit license", "cc by nc " * 40, "by " * 5000]
    texts += [rng.choice([" ", "-", "\n", "_"]).join(rng.choice(pool) for _ in range(rng.randint(1, 200))) for _ in range(80)]
    texts += ["released under the MIT License, " + "w " * 30 + "under the mit license", "Apache License, Version 2.0; CC BY-NC 4.0"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] * 2, "doc_id long, text string").withColumn("label", F.lit("theirs"))
    rows = licences.scan(docs).collect()
    assert len(rows) == 2 * len(texts)
    for r in rows:
        assert r.n_words == len(words_of(texts[r.doc_id]))
        assert sorted((p["first"], p.label) for p in r.places if p.exact) == base(texts[r.doc_id])
        assert all(0 < p.score <= 1 for p in r.places)


def test_license_texts_with_edits(spark, awkward, nothing):
    rng, docs, expected = random.Random(10), [], {}
    for text, label in licences.TEXTS.items():
        words = text.split()
        if len(words) > 12:
            words[5:5] = ["really"]
            del words[11]
        i = len(docs)
        docs.append((i, "w1 w2 " * rng.randint(0, 20) + " ".join(words).upper() + " w3"))
        expected[i] = label
    rows = licences.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    for r in rows:
        assert expected[r.doc_id] in {p.label for p in r.places}, docs[r.doc_id]
        assert all(p["last"] < r.n_words for p in r.places)
    assert licences.scan(awkward).count() == awkward.count() and licences.scan(nothing).count() == 0
