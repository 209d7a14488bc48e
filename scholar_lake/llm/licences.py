"""License scans by diagonal voting: word k-grams of a text and of the templates are joined, and vote for text place minus template place.

Only built-in functions. Every k-gram of every text is hashed and joined to the templates' k-grams (a broadcast table whose size is
that of TEMPLATES; its rows are counted before); hits whose words differ from the template's are dropped, which is the check of the spans
word by word. The votes and one marker row per document move once, by document. Votes for one diagonal are counted; diagonals of a
template at most ``drift`` apart become one span, so that a few added or lost words do not break it. A phrase is present where one diagonal has
all its k-grams; a license text where a span holds the share ``enough`` of its template's k-grams.

Defined results: null text has no words; texts of fewer than k words have no k-grams; equal rows give equal rows; an empty table gives an
empty table; only doc_id and text are looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 3
#: Phrases of the base scan, and opening words of public license texts with the labels they give.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
TEXTS = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis":
        "apache-2",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following": "bsd",
    "under the gnu general public license version 3": "gpl-3",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by": "gpl",
    "under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl",
    "licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "licensed under a creative commons attribution 4 0 international license": "cc-by",
    "licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
}
MOST_TEMPLATE_ROWS = 100_000


def words_of(text: Column) -> Column:
    """The words of a text, ASCII letters in lower case. lower() makes an ASCII letter only of the Kelvin sign, which is put aside
    before; no template has another letter that lower() could touch."""
    return F.regexp_extract_all(F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ"))), F.lit(WORDS), F.lit(0))


def gram_hashes(words: Column, k: int = K) -> Column:
    """Hashes of all runs of k words, by place. The words are bound to a variable first: a lambda would compute them for each place."""
    def over(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
        return F.when(F.size(w) >= k, each).otherwise(F.array().cast("array<bigint>"))
    return F.element_at(F.transform(F.array(words), over), 1)


def template_table(spark: SparkSession, phrases: dict[str, str], texts: dict[str, str], k: int = K) -> DataFrame:
    """A row per template and k-gram: template, exact, label, grams, at, t_words, t_hash."""
    rows = [(text, exact, label) for exact, group in ((True, phrases), (False, texts)) for text, label in group.items()]
    if sum(len(text.split()) for text, _, _ in rows) > MOST_TEMPLATE_ROWS:
        raise ValueError(f"templates of more than {MOST_TEMPLATE_ROWS} words in all are not broadcast")
    table = spark.createDataFrame(rows, "template string, exact boolean, label string").withColumn("w", F.split("template", " "))
    table = table.withColumn("grams", F.size("w") - k + 1).select("*", F.posexplode(gram_hashes(F.col("w"), k)).alias("at", "t_hash"))
    return table.withColumn("t_words", F.slice("w", F.col("at") + 1, F.lit(k))).drop("w")


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, texts: dict[str, str] = TEXTS, k: int = K, drift: int = 3,
         enough: float = 0.6) -> DataFrame:
    """A row per document: doc_id, n_words, and ``places``: an array of (label, exact, first, last, score), first to last word of a span."""
    worded = docs.select("doc_id", F.xxhash64("text").alias("key"), words_of(F.col("text")).alias("words"))
    hashed = worded.select("doc_id", "key", "words", F.size("words").cast("long").alias("n_words"),
                           F.concat(F.array(F.lit(None).cast("bigint")), gram_hashes(F.col("words"), k)).alias("hashes"))
    each = hashed.select("doc_id", "key", "words", "n_words", F.posexplode("hashes").alias("place", "t_hash"))
    templates = F.broadcast(template_table(docs.sparkSession, phrases, texts, k))
    joined = each.join(templates, "t_hash", "left")
    real = F.slice("words", F.greatest(F.col("place"), F.lit(1)), F.lit(k)) == F.col("t_words")
    votes = joined.where((F.col("place") == 0) | real).select(
        "doc_id", "key", "n_words", "template", "label", "exact", "grams", "at", (F.col("place") - 1 - F.col("at")).alias("diagonal"))
    document = ["doc_id", "key", "n_words"]
    template = [*document, "template", "label", "exact", "grams"]
    lines = votes.repartition(*document).groupBy(*template, "diagonal").agg(
        F.collect_set("at").alias("ats"), F.count(F.lit(1)).alias("rows"))
    order = Window.partitionBy(*template).orderBy("diagonal")
    apart = F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(order) > drift)
    spans = (lines.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
             .withColumn("span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    merged = spans.groupBy(*template, "span").agg(
        F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"), F.max("rows").alias("rows"),
        F.min(F.array_min("ats") + F.col("diagonal")).alias("first"), F.max(F.array_max("ats") + F.col("diagonal") + k - 1).alias("last"))
    score = F.size("ats") / F.col("grams")
    found = F.col("template").isNotNull() & (score >= F.when(F.col("exact"), 1.0).otherwise(enough))
    place = F.when(found, F.struct(F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last"),
                                   "label", "exact", score.alias("score")))
    copies = F.max(F.when(F.col("template").isNull(), F.col("rows")))
    by_document = merged.groupBy(*document).agg(F.array_sort(F.collect_list(place)).alias("places"), copies.alias("copies"))
    return by_document.select("doc_id", "n_words", "places", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")
