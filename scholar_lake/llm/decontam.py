"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

Words are runs of ASCII letters and digits (in lower case) and of non-ASCII characters. One pass counts in how many documents each word
n-gram of the test items occurs; of each item the rarer share of its n-grams are its seeds. A second pass finds the seeds in the documents, cuts a
window of the text around each place where an item may lie, and aligns item and window locally (match 2, mismatch and gap -1). The score is
the alignment's share of what the whole item would reach; edited and paraphrased copies keep most of it.

A pair is reported if the score reaches ``least`` and enough words are aligned: of an item of up to WHOLE_WORDS words all, of a longer one
all but one, and from LEAST_WORDS + 1 words on at least LEAST_WORDS (see ``least_score``). Of an item of over 2 * PASSAGE words a passage
is reported too, whatever its share of the item: PASSAGE words in a row, or as many more as make up for edits, three for each (a second alignment,
match 1, mismatch and gap -3, reaches PASSAGE). So that each passage has seeds, those of such items are chosen per stretch of STRETCH n-grams.

Items come as blocks of at most ``block_bytes`` of text, sent to all tasks; more items mean more blocks, each against all documents.
Documents are not shuffled. Defined results: null and blank texts and items match nothing, and nor do items of fewer words than an
n-gram; of equal items each is reported; equal documents give equal rows; empty tables on either side give an empty report; other columns are carried by ``clean`` and not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scholar_lake.llm import arrays

N = 3
RARE_SHARE, LEAST_SEEDS = 0.75, 10
#: Items of so few words must occur whole and without a gap; of longer ones all words but one, or this number of words, must be aligned.
WHOLE_WORDS, LEAST_WORDS = 5, 8
#: Words of a passage of a long item, and the price of an edit in it; 2 * STRETCH - 1 n-grams in a row hold a whole stretch, and a passage has that many.
PASSAGE, EDIT = 30, 3
STRETCH = (PASSAGE - N + 2) // 2
MATCH, MISMATCH, GAP = 2, 1, 1
FILTER_BITS = 22
SLICE_BYTES = 1 << 20
#: Pairs that are aligned together, and the most words that their windows have when padded (one pair may have more: 2.7 times its item's words).
PAIRS_AT_ONCE, PADDED_WORDS = 512, 1 << 20


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of each text's first word."""
    lower = arrays.LOWER[data]
    starts, stops, first = arrays.pieces(lower, offsets, arrays.PUNCTUATION)
    return arrays.piece_hashes(lower, starts, stops), first


def ngrams(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the n-grams that lie inside one text."""
    if len(words) < N:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = words[:len(words) - N + 1].copy()
    for i in range(1, N):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + words[i:len(words) - N + 1 + i]
    inside = np.ones(len(hashes), bool)
    ends = first[1:-1]
    for i in range(1, N):
        at = ends - i
        inside[at[(at >= 0) & (at < len(hashes))]] = False
    places = np.flatnonzero(inside)
    return places, arrays.mixed(hashes[places])


@dataclass
class Items:
    """A block of test items: words, and the seeds with the items and places that have them."""

    ids: np.ndarray
    words: np.ndarray
    first: np.ndarray
    seeds: np.ndarray  # distinct, sorted
    at: np.ndarray  # of each seed's occurrences in items: where a seed's begin (n + 1 numbers)
    item: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: list) -> "Items":
        words, first = word_hashes(*arrays.flat(pa.array(texts, pa.string())))
        places, hashes = ngrams(words, first)
        return cls(np.array(ids, np.int64), words, first, *cls.index(places, hashes, first))

    @staticmethod
    def index(places: np.ndarray, hashes: np.ndarray, first: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        seeds, at = np.unique(hashes[order], return_index=True)
        item = np.searchsorted(first, places[order], "right") - 1
        return seeds, np.append(at, len(order)), item, places[order] - first[item]

    def rare(self, documents: np.ndarray) -> "Items":
        """The same items with the rarer n-grams of each as seeds, by the number of documents that have them."""
        seed = np.repeat(np.arange(len(self.seeds)), np.diff(self.at))
        stretch = np.where(np.diff(self.first)[self.item] > 2 * PASSAGE, self.place // STRETCH, 0)
        order = np.lexsort((self.place, documents[seed], stretch, self.item))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(self.item[order]) != 0) | (np.diff(stretch[order]) != 0)
        begin = np.flatnonzero(new)
        items, count = self.item[order][begin], np.diff(np.append(begin, len(order)))
        rank = np.arange(len(order)) - np.repeat(begin, count)
        length = np.diff(self.first)[items]
        wanted = np.minimum(np.maximum(np.ceil(RARE_SHARE * count), LEAST_SEEDS), count)
        wanted = np.where(length <= WHOLE_WORDS, 1, wanted)  # these must occur whole, so the rarest n-gram finds them all
        kept = np.sort(order[rank < np.repeat(wanted, count)])
        places = self.place[kept] + self.first[self.item[kept]]
        return Items(self.ids, self.words, self.first, *self.index(places, self.seeds[seed[kept]], self.first))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are seeds: their places in hashes, and the seeds' numbers."""
        if not len(self.seeds):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not hasattr(self, "maybe"):
            self.maybe = np.zeros(1 << FILTER_BITS, bool)
            self.maybe[self.seeds & np.uint64((1 << FILTER_BITS) - 1)] = True
        likely = np.flatnonzero(self.maybe[hashes & np.uint64((1 << FILTER_BITS) - 1)])
        spot = np.minimum(np.searchsorted(self.seeds, hashes[likely]), len(self.seeds) - 1)
        hit = self.seeds[spot] == hashes[likely]
        return likely[hit], spot[hit]


def align(a: np.ndarray, b: np.ndarray, match: int = MATCH, mismatch: int = MISMATCH, gap: int = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman of many pairs (a row each, padded with numbers that never match): best scores, and where they end in b.

    Rows of the matrix are taken one by one; gaps along a row are a running maximum.
    """
    pairs, width = b.shape
    slope = gap * np.arange(width, dtype=np.int32)
    row, best, end = np.zeros((pairs, width), np.int32), np.zeros(pairs, np.int32), np.zeros(pairs, np.int64)
    for i in range(a.shape[1]):
        diagonal = np.zeros_like(row)
        diagonal[:, 1:] = row[:, :-1]
        now = np.maximum(diagonal + np.where(b == a[:, i:i + 1], match, -mismatch).astype(np.int32), row - gap)
        row = np.maximum(np.maximum.accumulate(np.maximum(now, 0) + slope, axis=1) - slope, 0)
        top = row.max(axis=1)
        better = top > best
        best[better], end[better] = top[better], row[better].argmax(axis=1)
    return best, end


def least_score(length: np.ndarray, least: float) -> np.ndarray:
    """The alignment score from which an item of so many words is reported.

    w aligned words with one edit between them score MATCH * w - 1, which fewer words cannot reach.
    """
    words = np.minimum(length - 1, LEAST_WORDS)
    enough = np.where(length <= WHOLE_WORDS, MATCH * length, MATCH * words - 1)
    return np.maximum(least * MATCH * length, enough)


def rows_of(words: np.ndarray, start: np.ndarray, stop: np.ndarray, pad: int, backwards: bool = False) -> np.ndarray:
    """Runs of words as the rows of a matrix; padded at the end."""
    lengths = stop - start
    columns = np.arange(int(lengths.max()))
    at = stop[:, None] - 1 - columns if backwards else start[:, None] + columns
    inside = columns < lengths[:, None]
    return np.where(inside, words[np.where(inside, at, 0)], np.uint64(pad))


def aligned_together(widths: np.ndarray) -> Iterator[slice]:
    """Runs of pairs, by the widths of their windows, that are few enough to be padded to the widest and aligned at once."""
    at = 0
    while at < len(widths):
        widest = np.maximum.accumulate(widths[at:at + PAIRS_AT_ONCE])
        fit = int((widest * np.arange(1, len(widest) + 1) <= PADDED_WORDS).sum())
        yield slice(at, at + max(fit, 1))
        at += max(fit, 1)


def leaks(words: np.ndarray, first: np.ndarray, items: Items, least: float) -> tuple[np.ndarray, ...]:
    """(text, item, score, first word, last word) of the best alignment of each text and item that is to be reported."""
    places, hashes = ngrams(words, first)
    hit, seed = items.find(hashes)
    many = items.at[seed + 1] - items.at[seed]
    which = np.repeat(items.at[seed], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    place, item = np.repeat(places[hit], many), items.item[which]
    length = (items.first[1:] - items.first[:-1])[item]
    text = np.searchsorted(first, place, "right") - 1
    cell = (place - first[text] - items.place[which]) // length
    windows = np.unique(np.stack([text, item, cell], axis=1), axis=0)
    text, item, cell = windows.T
    length = (items.first[1:] - items.first[:-1])[item]
    slack = 4 + length // 3
    start = np.clip(first[text] + cell * length - slack, first[text], first[text + 1])
    stop = np.clip(first[text] + (cell + 2) * length + slack, first[text], first[text + 1])
    score, end, begin = np.zeros(len(text)), np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
    reached = np.zeros(len(text), bool)
    order = np.argsort(length, kind="stable")
    for run in aligned_together((stop - start)[order]):
        own = order[run]
        item_from, item_to = items.first[item[own]], items.first[item[own] + 1]
        a, b = rows_of(items.words, item_from, item_to, 0), rows_of(words, start[own], stop[own], 1)
        best, at = align(a, b)
        score[own], end[own] = best / (MATCH * length[own]), start[own] + at
        reached[own] = best >= least_score(length[own], least)
        good = np.flatnonzero(reached[own])
        if len(good):  # the same backwards from the end gives the first word
            a = rows_of(items.words, item_from[good], item_to[good], 0, backwards=True)
            b = rows_of(words, start[own][good], end[own][good] + 1, 1, backwards=True)
            begin[own[good]] = end[own][good] - align(a, b)[1]
        part = np.flatnonzero(~reached[own] & (length[own] > 2 * PASSAGE) & (best >= MATCH * PASSAGE))
        if len(part):  # a passage of a long item
            a, b = rows_of(items.words, item_from[part], item_to[part], 0), rows_of(words, start[own][part], stop[own][part], 1)
            dense, at = align(a, b, 1, EDIT, EDIT)
            part, at = part[dense >= PASSAGE], at[dense >= PASSAGE]
            reached[own[part]], end[own[part]] = True, start[own][part] + at
        if len(part):
            a = rows_of(items.words, item_from[part], item_to[part], 0, backwards=True)
            b = rows_of(words, start[own][part], end[own][part] + 1, 1, backwards=True)
            begin[own[part]] = end[own][part] - align(a, b, 1, EDIT, EDIT)[1]
    good = np.flatnonzero(reached)
    good = good[np.lexsort((start[good], -score[good], item[good], text[good]))]
    one = np.concatenate(([True], (np.diff(text[good]) != 0) | (np.diff(item[good]) != 0)))[:len(good)]
    good = good[one]
    return text[good], item[good], score[good], begin[good] - first[text[good]], end[good] - first[text[good]]


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[Items]:
    """The items in blocks of about block_bytes at most, by hash; one block if that is enough."""
    known = benchmark.select("item_id", "text").where("text IS NOT NULL AND item_id IS NOT NULL")
    total = known.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = -(-total // block_bytes)
    for i in range(blocks):
        rows = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i).orderBy("item_id", "text").collect()
        yield Items.of([r["item_id"] for r in rows], [r["text"] for r in rows])


def with_rare_seeds(docs: DataFrame, items: Items) -> Items:
    """Counts in how many documents each n-gram of the items occurs, over all documents, and keeps each item's rare ones."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        total = np.zeros(len(block.seeds), np.int64)
        for part in arrays.chunks(batches, most=SLICE_BYTES):
            words, first = word_hashes(*arrays.flat(part.column("text")))
            places, hashes = ngrams(words, first)
            hit, seed = block.find(hashes)
            text = np.searchsorted(first, places[hit], "right") - 1
            total += np.bincount(np.unique(text * len(block.seeds) + seed) % max(len(block.seeds), 1), minlength=len(block.seeds))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["seed", "n"])
    counts = docs.select("text").mapInArrow(counted, "seed bigint, n bigint").groupBy("seed").agg(F.sum("n").alias("n")).collect()
    documents = np.zeros(len(items.seeds), np.int64)
    for row in counts:
        documents[row["seed"]] = row["n"]
    return items.rare(documents)


def find_leaks(docs: DataFrame, benchmark: DataFrame, least: float = 0.5, block_bytes: int = 8_000_000) -> DataFrame:
    """A row per document and item it contains: doc_id, item_id, score (0 to 1), first_word and last_word of the copy in the document."""
    wanted = docs.select("doc_id", "text")
    schema = "doc_id bigint, item_id bigint, score double, first_word bigint, last_word bigint"
    report = docs.sparkSession.createDataFrame([], schema)
    for items in item_blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(with_rare_seeds(wanted, items))

        def reported(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for part in arrays.chunks(batches, most=SLICE_BYTES):
                text, item, score, begin, end = leaks(*word_hashes(*arrays.flat(part.column("text"))), block, least)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(text)), pa.array(block.ids[item]), pa.array(score), pa.array(begin), pa.array(end)],
                    names=["doc_id", "item_id", "score", "first_word", "last_word"])
        report = report.unionByName(wanted.mapInArrow(reported, schema))
    return report


def clean(docs: DataFrame, benchmark: DataFrame, least: float = 0.5, block_bytes: int = 8_000_000) -> DataFrame:
    """docs without the documents that contain a test item."""
    kept = docs
    for items in item_blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(with_rare_seeds(docs, items))

        def filtered(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part in arrays.chunks(batches, most=SLICE_BYTES):
                dirty = leaks(*word_hashes(*arrays.flat(part.column("text"))), shared.value, least)[0]
                good = np.ones(part.num_rows, bool)
                good[dirty] = False
                yield part.filter(pa.array(good))
        kept = kept.mapInArrow(filtered, docs.schema)
    return kept
