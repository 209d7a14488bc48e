"""Texts of Arrow batches as flat byte arrays, and the words in them, for the operators that compute inside tasks with numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes that end a word: ASCII white space; for matching also ASCII punctuation.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
PUNCTUATION = np.ones(256, bool)
for _kept in (range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B), range(0x80, 0x100)):
    PUNCTUATION[list(_kept)] = False
LINE_ENDS = np.zeros(256, bool)
LINE_ENDS[10] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
CHUNK_BYTES = 1 << 19

_coefficients = np.zeros(0, np.uint64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null: empty), and the n + 1 offsets of the texts in them."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of text, so that memory depends on neither batch nor row count. A longer text
    is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = flat(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last


def pieces(data: np.ndarray, offsets: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes not in ``ends``, and for each text the number of its first run (n + 1 numbers)."""
    inside = ~ends[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    stops = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def mixed(numbers: np.ndarray) -> np.ndarray:
    """Well spread 64-bit numbers (the finalizer of SplitMix64)."""
    x = numbers.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def coefficients(n: int) -> np.ndarray:
    global _coefficients
    if len(_coefficients) < n:
        _coefficients = mixed(np.arange(max(n, 2 * len(_coefficients), 1024)))
    return _coefficients[:n]


def piece_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run: the sum of byte times a random coefficient of its place in the run, mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = stops - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    values = (data[place + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)) * coefficients(int(lengths.max()))[place]
    return mixed(np.add.reduceat(values, first))


def counts_by_text(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many marks each text has."""
    total = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in the union of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0
