import random

import corpus_pipeline
from conftest import SF


def test_unlearnt_languages_and_junk_go_and_short_texts_stay(spark):
    docs = spark.read.parquet(SF.replace("sf0.001", "sf0.01") + "/documents.parquet")
    rng = random.Random(1)
    odd = ["Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. " * 3,
           "Все люди рождаются свободными и равными в своем достоинстве и правах. " * 3, "人人生而自由在尊严和权利上一律平等" * 3,
           "".join(rng.choice("ABCDEFGHIJabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(268)), rng.randbytes(200).hex()]
    short = [w for r in docs.where("lang IS NOT NULL AND length(text) > 200").orderBy("doc_id").limit(10).collect()
             for w in (r.text[:12], r.text[:40])]
    more = spark.createDataFrame([(10 ** 9 + i, t, None, "x", len(t)) for i, t in enumerate(odd + short)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.unionByName(more), "").select("doc_id").collect()}
    assert not kept & set(range(10 ** 9, 10 ** 9 + len(odd)))
    asked = set(range(10 ** 9 + len(odd), 10 ** 9 + len(odd + short)))
    assert len(kept & asked) >= len(asked) - 1  # the start of a text may be as likely in another language
    labelled = {r.doc_id for r in docs.where("lang IS NOT NULL AND text RLIKE '[a-z]'").collect()}
    assert len(kept & labelled) >= 0.99 * len(labelled)
