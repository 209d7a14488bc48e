import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from scholar_lake.llm import arrays, repetition

SPACE = r"[^\x20\x09-\x0D]+"


def brute(text, min_words=4):
    words = re.findall(SPACE, text or "")
    n = len(words)

    def repeated(size):
        grams = Counter(tuple(words[i:i + size]) for i in range(n - size + 1))
        return [i for i in range(n - size + 1) if grams[tuple(words[i:i + size])] > 1]
    in_window = {j for i in repeated(8) for j in range(i, i + 8)}
    in_repeat = {j for i in repeated(min_words) for j in range(i, i + min_words)}
    longest = max([k for k in range(min_words, n + 1) if repeated(k)], default=0) if n < 400 else None
    lines = [x for x in (text or "").split("\n") if re.search(SPACE, x)]
    chars = sum(map(len, words))
    return {"n_words": n, "word_chars": chars, "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(in_window),
            "covered_fraction": sum(len(words[i]) for i in in_repeat) / max(chars, 1), "longest_repeat": longest}


def check(texts):
    got = repetition.measure(*arrays.flat(pa.array(texts, pa.string())), 4)
    for i, text in enumerate(texts):
        for name, value in brute(text).items():
            assert value is None or abs(got[name][i] - value) < 1e-9, (name, text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(["a", "b", "é#", "\n", " ", "ab "]), max_size=60).map(" ".join)), max_size=6))
def test_numbers_match_brute_force(texts):
    if texts:
        check(texts)


def test_lines_and_planted_repeats():
    rng = random.Random(2)
    block = " ".join(str(rng.random()) for _ in range(30))
    check([block + "\n" + block, "x\nx\n\nx \n", "", None, "a " * 300, block])


def test_depths_match_comparison_of_all_suffixes():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 3, 60)
    keys = np.append(words, 99)
    expected = [max((next((k for k in range(60) if max(i, j) + k >= 60 or words[i + k] != words[j + k]), 60) for j in range(60) if j != i))
                for i in range(60)]
    assert repetition.longest_repeats(keys.astype(np.uint64))[:60].tolist() == expected


def test_verdicts(awkward, nothing, spark):
    rows = {(r.doc_id, r.n_words): r for r in repetition.judge(awkward).collect()}
    assert awkward.count() == repetition.judge(awkward).count()
    assert rows[(10, 400)].base_failed and not rows[(10, 400)].kept
    assert rows[(0, 120)].kept and rows[(6, 20000)].kept
    assert rows[(3, 0)].base_failed and rows[(8, 1)].base_failed
    assert repetition.judge(nothing).count() == 0
    rng = random.Random(3)
    fresh = [str(rng.random()) for _ in range(400)]
    loop = spark.createDataFrame([(1, " ".join(fresh + fresh[:70])), (2, " ".join(fresh))], "doc_id long, text string")
    assert {r.doc_id: (r.base_failed, r.kept, r.longest_repeat) for r in repetition.judge(loop).collect()} == {1: (False, False, 70), 2: (False, True, 0)}
