"""Ranked lexical search by the Best Position Algorithm, over an index that is partitioned by documents.

A document's score for a query is the sum of the impacts of the query's terms in it (``impacts``). Two passes read the documents:

1. N, L and each query term's document frequency, counted in the tasks and summed by Spark.
2. Each task cuts its documents into blocks of about BLOCK_BYTES of text. In a block every query term has a list of (impact, document), highest
   impact first. A query reads its lists in parallel; a document met for the first time is looked up in all of the query's lists (direct
   access), and its places there count as seen. A list's best position is the end of the run of seen places from its top. No unseen document
   scores more than the sum of the impacts at the best positions, so the query stops as soon as that sum is strictly below the k-th
   score; at equality it goes on, as ties are decided by doc_id. The k-th score is carried from block to block of a task, so most
   blocks end after a few steps.

A task returns k documents a query at most; Spark ranks those. Queries are read in blocks of about ``query_bytes`` of text, each of which goes to all tasks and
takes the two passes; documents are never paired with queries outside the lists.

Defined results: null, empty and blank texts have no terms and are not found; a query without terms has no rows; rows with equal ids are ranked
one by one; null ids come after all others among equal scores; equal query rows are queries of their own; an empty table gives
an empty table; only item_id, doc_id and text are looked at. Terms are told apart by 64-bit hashes. A text is processed whole, at about
40 bytes of memory per byte.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from scholar_lake.llm import arrays

BLOCK_BYTES = 6 << 20
#: Places read from each list in a query's first step; every further step reads twice as many.
FIRST_STEP = 32
PARTIAL = "item bigint, doc_id bigint, score bigint"


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms, and the number of each text's first term."""
    data, offsets = arrays.flat(column)
    lower = arrays.LOWER[data]
    starts, stops, first = arrays.pieces(lower, offsets, arrays.PUNCTUATION)
    return arrays.piece_hashes(lower, starts, stops), first


@dataclass
class Queries:
    """Queries as sets of terms: ids, the sorted hashes of all terms, and each query's terms as places among those."""
    ids: list
    vocabulary: np.ndarray
    terms: list[np.ndarray]

    @staticmethod
    def of(ids: list, texts: list[str | None]) -> Queries:
        hashes, first = terms_of(pa.array(texts, pa.string()))
        vocabulary = np.unique(hashes)
        return Queries(ids, vocabulary, [np.unique(np.searchsorted(vocabulary, hashes[a:b])) for a, b in zip(first[:-1], first[1:])])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are query terms, and which ones."""
        if not len(self.vocabulary):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        hit = np.flatnonzero(self.vocabulary[at] == hashes)
        return hit, at[hit]


@dataclass
class Statistics:
    documents: int
    length: int
    weights: np.ndarray

    @staticmethod
    def of(documents: int, length: int, frequencies: np.ndarray) -> Statistics:
        weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequencies.tolist()]
        return Statistics(documents, length, np.array(weights, np.int64))

    def impacts(self, term: np.ndarray, tf: np.ndarray, terms_in_doc: np.ndarray) -> np.ndarray:
        m = 100 - 50 + (50 * terms_in_doc * self.documents) // max(self.length, 1)
        return self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def query_blocks(queries: DataFrame, query_bytes: int) -> Iterator[Queries]:
    """The queries in blocks of about query_bytes of text, by hash."""
    known = queries.select("item_id", "text")
    total = known.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    blocks = -(-total // query_bytes)
    for i in range(blocks):
        rows = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i).orderBy("item_id", "text").collect()
        yield Queries.of([r["item_id"] for r in rows], [r["text"] for r in rows])


def statistics(docs: DataFrame, queries: Queries) -> Statistics:
    """Corpus statistics; as many rows reach the driver as the block of queries has terms."""
    shared = docs.sparkSession.sparkContext.broadcast(queries.vocabulary)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Queries([], shared.value, [])
        documents, length, frequencies = 0, 0, np.zeros(len(block.vocabulary), np.int64)
        for part in arrays.chunks(batches):
            hashes, first = terms_of(part.column("text"))
            hit, term = block.find(hashes)
            text = np.searchsorted(first, hit, "right") - 1
            frequencies += np.bincount(np.unique(text * len(frequencies) + term) % max(len(frequencies), 1), minlength=len(frequencies))
            documents, length = documents + int(np.count_nonzero(np.diff(first))), length + len(hashes)
        some = np.flatnonzero(frequencies)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *some]), pa.array([documents, length, *frequencies[some]])], names=["term", "n"])
    counts = docs.select("text").mapInArrow(counted, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {row["term"]: row["n"] for row in counts}
    return Statistics.of(found.get(-2, 0), found.get(-1, 0), np.array([found.get(t, 0) for t in range(len(queries.vocabulary))], np.int64))


class ImpactLists:
    """The lists of one block of documents.

    ``keys`` (term * documents + document) is sorted, for direct access; ``place`` tells where such an entry stands in its list.
    """

    def __init__(self, column: pa.Array, queries: Queries, known: Statistics):
        hashes, first = terms_of(column)
        self.size = len(first) - 1
        hit, term = queries.find(hashes)
        text = np.searchsorted(first, hit, "right") - 1
        self.keys, tf = np.unique(term * self.size + text, return_counts=True)
        term, text = self.keys // max(self.size, 1), self.keys % max(self.size, 1)
        self.impact = known.impacts(term, tf, np.diff(first)[text])
        order = np.lexsort((-self.impact, term))
        self.doc, self.falling = text[order], self.impact[order]
        self.start = np.searchsorted(term, np.arange(len(queries.vocabulary) + 1))
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))

    def lookup(self, terms: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of documents for some terms, and the places of the entries that make them up."""
        wanted = (terms[:, None] * self.size + docs[None, :]).ravel()
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        there = self.keys[at] == wanted
        scores = np.where(there, self.impact[at], 0).reshape(len(terms), len(docs)).sum(axis=0)
        return scores, self.place[at[there]]

    def best(self, terms: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores, all of the block's k best among them; those below ``floor``, the k-th score so far, need not be."""
        terms = terms[self.start[terms] < self.start[terms + 1]]
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(terms):
            return docs, scores
        begin, stop = self.start[terms], self.start[terms + 1]
        seen = np.zeros(len(self.doc), bool)
        run, met = np.zeros(len(terms), np.int64), np.zeros(self.size, bool)
        depth, step = 0, FIRST_STEP
        while True:
            read = np.concatenate([self.doc[a + depth:min(a + depth + step, b)] for a, b in zip(begin, stop)])
            new = np.unique(read[~met[read]])
            met[new] = True
            if len(new):
                added, places = self.lookup(terms, new)
                docs, scores = np.concatenate((docs, new)), np.concatenate((scores, added))
                seen[places] = True
            for i in range(len(terms)):
                rest = seen[begin[i] + run[i]:stop[i]]
                run[i] += len(rest) if rest.all() else int(rest.argmin())
            depth, step = depth + step, 2 * step
            most = int(self.falling[begin + run - 1][run < stop - begin].sum())
            kth = max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k])) if len(scores) >= k else floor
            if most < kth or (run == stop - begin).all():
                good = scores >= max(kth, 1)
                return docs[good], scores[good]


def search(docs: DataFrame, queries: DataFrame, k: int = 50, query_bytes: int = 4_000_000) -> DataFrame:
    """item_id, rank, doc_id and score of each query's k documents of the highest score above 0, equal scores by doc_id."""
    wanted = docs.select("doc_id", "text")
    spark = docs.sparkSession
    result = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for block in query_blocks(queries, query_bytes):
        shared = spark.sparkContext.broadcast((block, statistics(wanted, block)))

        def searched(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block, known = shared.value
            top = [(np.zeros(0, np.int64),) * 3 for _ in block.terms]  # score, whether the id is null, id
            for part in arrays.chunks(batches, most=BLOCK_BYTES):
                lists = ImpactLists(part.column("text"), block, known)
                ids = part.column("doc_id")
                null, ids = np.asarray(ids.is_null()).astype(np.int64), ids.fill_null(0).to_numpy()
                for i, terms in enumerate(block.terms):
                    score, none, doc = top[i]
                    found, scores = lists.best(terms, k, int(score[-1]) if len(score) == k else 0)
                    if len(found):
                        score, none, doc = (np.concatenate(x) for x in ((score, scores), (none, null[found]), (doc, ids[found])))
                        first = np.lexsort((doc, none, -score))[:k]
                        top[i] = score[first], none[first], doc[first]
            for i, (score, none, doc) in enumerate(top):
                if len(score):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), i)), pa.array(doc, mask=none.astype(bool)), pa.array(score)],
                                                     names=["item", "doc_id", "score"])
        ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = wanted.mapInArrow(searched, PARTIAL).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        listed = spark.createDataFrame(list(enumerate(block.ids)), "item bigint, item_id bigint")
        best = best.join(listed, "item")
        result = result.unionByName(best.select("item_id", "rank", "doc_id", "score"))
    return result
