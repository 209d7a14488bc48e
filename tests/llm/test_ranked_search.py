import math
import random
import re
from collections import Counter

import pytest

from scholar_lake.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_definition(docs, queries, k):
    known = [(i, Counter(terms(t))) for i, t in docs]
    known = [(i, c, sum(c.values())) for i, c in known if c]
    total, length = len(known), sum(n for *_, n in known)
    frequencies = Counter(t for _, c, _ in known for t in c)
    result = []
    for item, text in queries:
        scores = []
        for doc, counts, n in known:
            m = 50 + 50 * n * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * frequencies[t] + 1))) * (10 ** 9 * counts[t] // (1000 * counts[t] + 20 * m))
                        for t in set(terms(text)) if t in counts)
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        result += [(item, rank, doc, -score) for rank, (score, _, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(result, key=repr)


def found(spark, docs, queries, k=50, **more):
    made = ranked_search.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(queries, "item_id long, text string"), k, **more)
    return sorted((tuple(r) for r in made.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    """Words of very different frequencies, so that lists are long and short, and many equal scores."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([3, 10, 60])))) for i in range(600)]
    docs += [(600 + i, docs[0][1]) for i in range(80)]  # ties beyond k
    return docs, [(i, " ".join(rng.choices(words, k=rng.choice([1, 2, 12])))) for i in range(25)] + [(99, docs[0][1])]


@pytest.mark.parametrize("block, step, k", [(6 << 20, 32, 50), (2000, 1, 7), (500, 3, 50)])
def test_equals_full_scoring(spark, corpus, monkeypatch, block, step, k):
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", block)
    monkeypatch.setattr(ranked_search, "FIRST_STEP", step)
    assert found(spark, *corpus, k) == by_definition(*corpus, k)


def test_queries_in_blocks(spark, corpus):
    assert found(spark, *corpus, 10, query_bytes=150) == by_definition(*corpus, 10)


def test_lists_are_not_read_to_the_end(corpus):
    """The early stop stops early."""
    import pyarrow as pa
    docs, _ = corpus
    queries = ranked_search.Queries.of([0], ["w150 w0 w1"])
    column = pa.array([t for _, t in docs])
    hashes, first = ranked_search.terms_of(column)
    hit, term = queries.find(hashes)
    frequencies = [len({int(x) for x, y in zip(first.searchsorted(hit, "right"), term) if y == t}) for t in range(3)]
    known = ranked_search.Statistics.of(len(docs), len(hashes), ranked_search.np.array(frequencies))
    lists = ranked_search.ImpactLists(column, queries, known)
    read = []
    lookup = lists.lookup
    lists.lookup = lambda terms, docs: read.append(len(docs)) or lookup(terms, docs)
    lists.best(queries.terms[0], 2, 0)
    assert sum(read) < 0.5 * len(docs)


def test_awkward_rows(spark, awkward, nothing):
    queries = [(1, "one É line"), (1, "one É line"), (2, None), (3, ""), (None, "façon"), (4, "absent")]
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    asked = spark.createDataFrame(queries, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS score")
    got = sorted((tuple(r) for r in ranked_search.search(awkward, asked).collect()), key=repr)
    assert got == by_definition(docs, queries, 50)
    assert ranked_search.search(nothing, asked).count() == 0
    assert ranked_search.search(awkward, asked.limit(0)).count() == 0
