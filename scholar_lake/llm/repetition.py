"""Quality rules: how much of a text repeats inside it, from a suffix array over its words.

Each text's words (as hashes) end with a mark of their own; suffixes are sorted by prefix doubling, where each round only sorts those that
are still tied, and the longest common prefixes of neighbours follow from the rounds' classes. A suffix's deepest LCP interval
gives the longest repeated string that starts there; it is a maximal repeat unless the suffix one word to the left has one longer by that word.
The maximal repeats of ``min_words`` words and more are united, and a text is rejected if they cover more than ``most_covered`` of its word
characters, or if the longest has more than ``longest`` words.

Texts are taken in slices of some MB, all texts of a slice at once; nothing is shuffled. Defined results: null and blank texts have no
words and fail the base rule; equal rows give equal rows; an empty table gives an empty table; only doc_id and text are looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scholar_lake.llm import arrays

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
WINDOW = 8
SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, kept boolean, covered_fraction double, longest_repeat bigint, n_repeats bigint")


def suffix_array(keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and the classes of the strings of 1, 2, 4, ... tokens at each place, each class named by its place in the order.

    Every text must end with a key that no other place has; then no string that is found twice reaches beyond its text.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    new = np.concatenate(([True], keys[order][1:] != keys[order][:-1]))
    classes = np.empty(n, np.int64)
    classes[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, step = [classes], 1
    while True:
        active = np.flatnonzero(np.bincount(classes, minlength=n)[classes] > 1)
        if not len(active):
            break
        pair = classes[active] * n + classes[active + step]
        sort = np.argsort(pair, kind="stable")
        active, pair = active[sort], pair[sort]
        group, at = classes[active], np.arange(len(active))
        group_start = np.maximum.accumulate(np.where(np.concatenate(([True], group[1:] != group[:-1])), at, 0))
        start = np.maximum.accumulate(np.where(np.concatenate(([True], pair[1:] != pair[:-1])), at, 0))
        classes = classes.copy()
        classes[active] = group + start - group_start
        levels.append(classes)
        step *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[classes] = np.arange(n)
    return suffixes, levels


def neighbour_prefixes(suffixes: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Tokens that each suffix shares with the one before it in the order; 0 for the first."""
    n = len(suffixes)
    shared = np.zeros(n, np.int64)
    left, right = suffixes[:-1], suffixes[1:]
    for i in range(len(levels) - 1, -1, -1):
        a, b = left + shared[1:], right + shared[1:]
        fits = (a < n) & (b < n)
        same = np.zeros(n - 1, bool)
        same[fits] = levels[i][a[fits]] == levels[i][b[fits]]
        shared[1:] += same.astype(np.int64) << i
    return shared


def longest_repeats(keys: np.ndarray) -> np.ndarray:
    """For each place the length of the longest string that starts there and somewhere else too: the depth of its LCP interval."""
    suffixes, levels = suffix_array(keys)
    shared = neighbour_prefixes(suffixes, levels)
    depth = np.empty(len(keys), np.int64)
    depth[suffixes] = np.maximum(shared, np.append(shared[1:], 0))
    return depth


def text_keys(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts with an end mark after each text, keyed so that words of different texts differ; and each word's place."""
    texts = len(first) - 1
    owner = np.repeat(np.arange(texts), np.diff(first))
    places = np.arange(len(hashes)) + owner
    keys = np.empty(len(hashes) + texts, np.uint64)
    salt = arrays.mixed(np.arange(texts) + (1 << 40))
    keys[places] = arrays.mixed(hashes ^ salt[owner])
    keys[first[1:] + np.arange(texts)] = arrays.mixed(salt)
    return keys, places


def measure(data: np.ndarray, offsets: np.ndarray, min_words: int) -> dict[str, np.ndarray]:
    """The numbers of each text."""
    texts = len(offsets) - 1
    starts, stops, first = arrays.pieces(data, offsets, arrays.SPACES)
    hashes = arrays.piece_hashes(data, starts, stops)
    owner = np.repeat(np.arange(texts), np.diff(first))
    characters = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)))
    word_chars = characters[stops] - characters[starts]

    keys, places = text_keys(hashes, first)
    depth = longest_repeats(keys) if len(keys) else np.zeros(0, np.int64)
    twice = np.flatnonzero(depth >= WINDOW)
    in_window = arrays.covered(twice, np.full(len(twice), WINDOW), len(keys))[places]
    before = np.concatenate(([0], depth[:-1])) if len(depth) else depth
    maximal = np.flatnonzero((depth >= min_words) & (before != depth + 1))
    in_repeat = arrays.covered(maximal, depth[maximal], len(keys))[places]
    key_owner = np.empty(len(keys), np.int64)
    key_owner[places], key_owner[first[1:] + np.arange(texts)] = owner, np.arange(texts)
    longest = np.zeros(texts, np.int64)
    np.maximum.at(longest, key_owner[maximal], depth[maximal])

    line_starts, line_stops, line_first = arrays.pieces(data, offsets, arrays.LINE_ENDS)
    line_owner = np.repeat(np.arange(texts), np.diff(line_first))
    with_word = np.searchsorted(starts, line_stops) > np.searchsorted(starts, line_starts)
    line_hashes = arrays.piece_hashes(data, line_starts, line_stops)[with_word]
    line_owner = line_owner[with_word]
    distinct, at = np.unique(arrays.mixed(line_hashes ^ arrays.mixed(line_owner)), return_index=True)

    def by_text(who: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(who, weights=weights, minlength=texts).astype(np.int64)
    total_chars = by_text(owner, word_chars)
    return {
        "n_words": np.diff(first), "word_chars": total_chars, "n_symbols": arrays.counts_by_text(SYMBOLS[data], offsets),
        "n_dup_lines": by_text(line_owner) - by_text(line_owner[at]), "n_repeat_words": by_text(owner[in_window]),
        "covered_fraction": by_text(owner[in_repeat], word_chars[in_repeat]) / np.maximum(total_chars, 1),
        "longest_repeat": longest, "n_repeats": by_text(key_owner[maximal]),
    }


def judge(docs: DataFrame, min_words: int = 4, most_covered: float = 0.35, longest: int = 60) -> DataFrame:
    """A row per document: the base numbers and verdict, the repeats' share, longest and number, and ``kept``."""
    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrays.chunks(batches):
            row = measure(*arrays.flat(part.column("text")), min_words)
            row["base_failed"] = (row["n_words"] < 20) | (100 * row["n_repeat_words"] > 30 * row["n_words"])
            row["kept"] = ~row["base_failed"] & (row["covered_fraction"] <= most_covered) & (row["longest_repeat"] <= longest)
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(row[c]) for c in names[1:]]], names=names)
    return docs.select("doc_id", "text").mapInArrow(judged, SCHEMA)
