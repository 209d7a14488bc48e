import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from llm.tools import groups
from scholar_lake.llm import minhash


def by_definition(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))) if words else frozenset()


def expected(rows):
    sets = [by_definition(t) for _, t in rows]
    edges = [(i, j) for i, j in combinations(range(len(rows)), 2)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    result = []
    for members in groups(len(rows), edges):
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        least = min(ids) if ids else None
        result += [(rows[i][0], len(sets[i]), least, rows[i][0] == least) for i in members]
    return sorted(result, key=repr)


def found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in minhash.near_duplicates(docs).collect()), key=repr)


def edited(rng, words, share):
    return [w if rng.random() >= share else f"n{rng.randrange(10 ** 6)}" for w in words]


@pytest.fixture(scope="module")
def families():
    """Originals with copies whose similarities lie on both sides of the limit, and chains of small edits."""
    rng, rows = random.Random(3), []
    for f in range(6):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([8, 60, 150]))]
        texts = [base] + [edited(rng, base, rng.choice([0.005, 0.01, 0.02, 0.03, 0.05])) for _ in range(25)]
        for _ in range(8):
            base = edited(rng, base, 0.01)
            texts.append(base)
        rows += [(f * 100 + i, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def test_components_match_all_pairs(spark, families):
    assert found(spark, families) == expected(families)


def test_large_buckets_in_many_blocks(spark, families, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "NEAREST", 1)
    monkeypatch.setattr(minhash, "CENTRES", 1)
    assert found(spark, families) == expected(families)


def test_only_nodes_with_candidates_held_back_are_compared_again(spark, families, monkeypatch):
    monkeypatch.setattr(minhash, "NEAREST", 1)
    monkeypatch.setattr(minhash, "CENTRES", 1)
    asked, across = [], minhash.across

    def counted(members, nearest):
        asked.append(members.where("asked").count())
        return across(members, nearest)
    monkeypatch.setattr(minhash, "across", counted)
    assert found(spark, families) == expected(families)
    assert len(asked) > 1 and asked[0] > asked[-1] > 0


def test_exact_limit_and_short_texts(spark):
    letters = [f"t{i}" for i in range(40)]
    rows = [(1, "one"), (2, "ONE"), (3, "one two"), (4, "one  two"), (5, "a b c"), (6, "a b c d"), (7, None), (8, ""), (9, " \n"), (None, "one"), (None, None),
            (10, " ".join(letters)), (11, " ".join(letters[:35])), (12, " ".join(letters[:34]))]  # 38, 33 and 32 shingles: 33 of 38 is over 0.85, 32 of 38 not
    assert found(spark, rows) == expected(rows)


def test_awkward_rows(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert sorted((tuple(r) for r in minhash.near_duplicates(awkward).collect()), key=repr) == expected(rows)
    assert minhash.near_duplicates(nothing).count() == 0


def test_filters_never_drop_a_pair_at_the_limit():
    rng, texts = random.Random(9), []
    for n in (7, 30, 100, 1000, 5000):
        for _ in range(20):
            base = [f"u{rng.randrange(10 ** 7)}" for _ in range(n)]
            cut = int(0.15 * n)  # the front is missing: 0.85 of the shingles, or just more
            texts += [" ".join(base), " ".join(base[cut:])]
    hashes, begin = minhash.shingle_sets(pa.array(texts))
    sizes = np.diff(begin)
    samples = minhash.signatures(hashes, begin[:-1])
    owner = np.repeat(np.arange(len(sizes)), minhash.SAMPLES)
    spread = (minhash.arrays.mixed((samples + minhash._factors).ravel()) % np.uint64(minhash.SKETCH_BITS)).astype(np.int64)
    whole = (minhash.arrays.mixed(hashes) % np.uint64(minhash.PARITY_BITS)).astype(np.int64)
    sketch = minhash.parities(spread, owner, len(sizes), minhash.SKETCH_BITS).view(np.uint64)
    parity = minhash.parities(whole, np.repeat(np.arange(len(sizes)), sizes), len(sizes), minhash.PARITY_BITS).view(np.uint64)
    for i in range(0, len(texts), 2):
        shared = len(np.intersect1d(hashes[begin[i]:begin[i + 1]], hashes[begin[i + 1]:begin[i + 2]]))
        if 100 * shared >= 85 * (sizes[i] + sizes[i + 1] - shared):
            assert len(minhash.similar(sketch[i], parity[i], sizes[i], sketch[[i + 1]], parity[[i + 1]], sizes[[i + 1]])[0])
    strangers = [len(minhash.similar(sketch[i], parity[i], sizes[i], sketch[[i + 2]], parity[[i + 2]], sizes[[i + 2]])[0]) for i in range(0, len(texts) - 2, 2)]
    assert not any(strangers)
