import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from scholar_lake.llm import simhash
from llm.tools import groups


def by_definition(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(len(words) - shingle + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "one", "One TWO", "a b c", "É é a B c\x0bd\x1fe f  g", "x y " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode() if text is not None else None) & (2 ** 64 - 1) == by_definition(text)


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks, rng = simhash.covering_masks(radius), random.Random(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    sets = combinations(range(64), radius) if radius < 4 else (rng.sample(range(64), 4) for _ in range(20000))
    assert all(any(not sum(1 << b for b in bits) & m for m in masks) for bits in sets)


def near_sets(prints, radius):
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
    return groups(len(prints), zip(*np.nonzero(near)))


def clouds(rng, centres, each, flips):
    made = []
    for _ in range(centres):
        c = rng.getrandbits(64)
        made += [c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))) for _ in range(each)]
    return np.array(made, np.uint64)


def test_large_buckets_lose_no_link(monkeypatch):
    monkeypatch.setattr(simhash, "DIRECT", 16)
    prints = clouds(random.Random(1), 6, 120, 5)
    found = simhash.bucket_links(prints, list(range(64)), 3)
    edges = [(int(a), int(b)) for x, y in found for a, b in zip(x, y)]
    assert groups(len(prints), edges) == near_sets(prints, 3)


def test_components_match_all_pairs(spark):
    prints = clouds(random.Random(2), 40, 25, 4)
    rows = [(int(p), [int(p)]) for p in np.unique(prints).view(np.int64)]
    nodes = spark.createDataFrame(rows, "node long, prints array<long>")
    roots = {r.node: r.root for r in simhash.components(simhash.links(nodes, 3)).collect()}
    values = [p for p, _ in rows]
    expected = near_sets(np.array(values, np.int64).view(np.uint64), 3)
    by_root = {}
    for v in values:
        by_root.setdefault(roots.get(v, v), []).append(v)
    assert sorted(map(sorted, by_root.values())) == sorted(sorted(values[i] for i in g) for g in expected)


def test_heavy_buckets_are_split_without_loss(spark, monkeypatch):
    calls, heavy_keys = [], simhash.heavy_keys

    def eager(rows, key):
        found = heavy_keys(rows, key, tasks=2000)
        calls.append(found.count())
        return found
    monkeypatch.setattr(simhash, "heavy_keys", eager)
    prints = clouds(random.Random(7), 2, 150, 4)
    rows = [(int(p), [int(p)]) for p in np.unique(prints).view(np.int64)]
    roots = {r.node: r.root for r in simhash.components(simhash.links(spark.createDataFrame(rows, "node long, prints array<long>"), 3)).collect()}
    values = [p for p, _ in rows]
    by_root = {}
    for v in values:
        by_root.setdefault(roots.get(v, v), []).append(v)
    expected = near_sets(np.array(values, np.int64).view(np.uint64), 3)
    assert calls[0] > 0
    assert sorted(map(sorted, by_root.values())) == sorted(sorted(values[i] for i in g) for g in expected)


def test_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)], "a long, b long")
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def test_awkward_rows(awkward, nothing):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    ids = {}
    for r in rows:
        ids.setdefault(r.component, set()).add(r.component_id)
    assert all(len(v) == 1 for v in ids.values())
    assert {r.component_id for r in rows if r.doc_id in (3, 4, 5)} == {3}
    assert {r.component_id for r in rows if r.doc_id in (0, 1)} == {0}
    assert simhash.near_duplicates(nothing).count() == 0
