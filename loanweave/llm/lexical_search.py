"""Ranked lexical search: short posting lists summed into accumulators, which then join the long lists as one iterator.

Tasks reduce every document to its length and the counts of terms that the queries hold, written once; counts over all
documents give the weights. Tasks then read these bags in chunks of about ``POSTINGS`` postings, turn a chunk into posting
lists and run every query over it. Short lists are summed term at a time into accumulators, sorted by document and with
bounds of their own; documents are then visited window by window over the accumulators and the long lists. A window whose
bounds cannot reach the query's tenth score so far is skipped; inside one, lists are merged from the largest bound down
until the rest cannot lift a new document, and the rest is only probed at documents still able to enter. Each task keeps
``k`` results a query, and these lists are merged in two steps.

Queries are collected in blocks of ``BLOCK_CHARS`` characters; documents are never collected and no term is a shuffle key,
so a very frequent one costs its postings alone.

A null, empty or termless text has no terms, is no document of the counts and is never a result; such a query has no
results. Repeated rows are documents (or queries) of their own and each has its rank; equal scores go by smaller doc_id,
null ids last. Texts are read whole. An empty table on either side gives no rows. Other columns are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Fixed value: a term is a run of letters and digits of ASCII and of anything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Characters of queries that are held at once, postings of a chunk of documents, and documents of a window.
BLOCK_CHARS, POSTINGS, WINDOW = 1 << 24, 4_000_000, 2_048
#: A list is short if it holds less than this share of a chunk's documents.
SHORT = 1 / 16
#: Groups in which the tasks' lists are merged first.
GROUPS = 64

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def terms_of(text: Column) -> Column:
    """The terms of ``text`` in order, with A-Z alone in lower case; a null text has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _CAPITALS, _CAPITALS.lower()), F.lit(TERM), F.lit(0))


def bags(documents: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, n (terms with repeats), and terms (places in ``terms``) with their counts, of documents that have a term."""
    shared = documents.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {term: i for i, term in enumerate(shared.value)}
        width = max(len(place), 1)
        for batch in batches:
            lists = batch.column("words")
            coded = lists.flatten().dictionary_encode()
            known = np.array([place.get(word, -1) for word in coded.dictionary.to_pylist()], np.int64)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            at = known[coded.indices.to_numpy()] if len(known) else known
            row = np.repeat(np.arange(len(sizes)), sizes)
            cells, counts = np.unique((row * width + at)[at >= 0], return_counts=True)
            ends = np.searchsorted(cells, np.arange(len(sizes) + 1) * width).astype(np.int32)
            listed = lambda values: pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), listed(cells % width), listed(counts)], ["doc_id", "n", "terms", "counts"]
            ).filter(pa.array(sizes > 0))

    words = documents.select(F.col("doc_id").cast("long"), terms_of(F.col("text")).alias("words"))
    return words.mapInArrow(count, "doc_id long, n long, terms array<int>, counts array<int>")


@dataclass
class Query:
    """Terms with their weights (times their repeats in the query), and the best results so far."""

    terms: list[int]
    weights: list[int]
    score: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    doc_id: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    known: np.ndarray = field(default_factory=lambda: np.empty(0, bool))

    def offer(self, k: int, score: np.ndarray, doc_id: np.ndarray, known: np.ndarray) -> None:
        score, doc_id, known = np.append(self.score, score), np.append(self.doc_id, doc_id), np.append(self.known, known)
        best = np.lexsort((doc_id, ~known, -score))[:k]
        self.score, self.doc_id, self.known = score[best], doc_id[best], known[best]

    def bar(self, k: int) -> int:
        """Least score that can still enter; only scores above zero count."""
        return max(1, int(self.score[-1])) if len(self.score) == k else 1


@dataclass
class List:
    """Documents (ascending places in the chunk) of one term, what each adds to a score of weight one, and bounds by window."""

    docs: np.ndarray
    adds: np.ndarray
    starts: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, docs: np.ndarray, adds: np.ndarray, windows: int) -> List:
        starts = np.searchsorted(docs, np.arange(windows + 1) * WINDOW)
        bounds = np.zeros(windows, np.int64)
        full = np.nonzero(starts[1:] > starts[:-1])[0]
        if len(full):
            bounds[full] = np.maximum.reduceat(adds, starts[full])
        return cls(docs, adds, starts, bounds)

    def part(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        here = slice(self.starts[window], self.starts[window + 1])
        return self.docs[here], self.adds[here]


class Chunk:
    """Posting lists of some documents."""

    def __init__(self, batches: list[pa.RecordBatch], documents: int, terms: int):
        table = pa.Table.from_batches(batches).combine_chunks()
        ids = table.column("doc_id").combine_chunks()
        self.known = ids.is_valid().to_numpy(zero_copy_only=False)
        self.doc_id = ids.fill_null(0).to_numpy(zero_copy_only=False)
        n = table.column("n").to_numpy()
        m = 25 + (75 * n * documents) // terms
        lists = table.column("terms").combine_chunks()
        size = lists.value_lengths().to_numpy(zero_copy_only=False)
        counts = table.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(n)), size)
        adds = (1_000_000_000 * counts) // (1000 * counts + 8 * m[doc])
        term = lists.flatten().to_numpy()
        order = np.argsort(term, kind="stable")
        term, self.doc, self.adds = term[order], doc[order], adds[order]
        self.terms, first = np.unique(term, return_index=True)
        self.ends = np.append(first, len(term))
        self.windows = -(-len(n) // WINDOW)
        self.lists: dict[int, List] = {}

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.terms, term)
        if k == len(self.terms) or self.terms[k] != term:
            return self.doc[:0], self.adds[:0]
        here = slice(self.ends[k], self.ends[k + 1])
        return self.doc[here], self.adds[here]

    def long_list(self, term: int) -> List:
        if term not in self.lists:
            self.lists[term] = List.of(*self.postings(term), self.windows)
        return self.lists[term]

    def accumulators(self, query: Query) -> tuple[List | None, list[tuple[int, List]]]:
        """The query's short lists summed into one list, and its long ones with their weights."""
        docs, adds, long = [], [], []
        for term, weight in zip(query.terms, query.weights):
            own, each = self.postings(term)
            if len(own) >= SHORT * len(self.doc_id):
                long.append((weight, self.long_list(term)))
            elif len(own):
                docs.append(own)
                adds.append(weight * each)
        if not docs:
            return None, long
        doc, add = np.concatenate(docs), np.concatenate(adds)
        order = np.argsort(doc, kind="stable")
        places, first = np.unique(doc[order], return_index=True)
        return List.of(places, np.add.reduceat(add[order], first), self.windows), long

    def run(self, query: Query, k: int) -> None:
        """Offer the query every document of the chunk that can be among its best ``k``."""
        summed, lists = self.accumulators(query)
        bar = query.bar(k)
        if summed is not None:
            lists.append((1, summed))
            if len(summed.adds) >= k:
                # k documents reach this with their accumulators alone
                bar = max(bar, int(np.partition(summed.adds, -k)[-k]))
        if not lists:
            return
        bounds = np.stack([weight * x.bounds for weight, x in lists])
        total = bounds.sum(axis=0)
        for window in range(self.windows):
            if total[window] < bar:
                continue
            order = np.argsort(-bounds[:, window], kind="stable")
            rest = bounds[order, window][::-1].cumsum()[::-1]
            base = window * WINDOW
            score = np.zeros(min(WINDOW, len(self.doc_id) - base), np.int64)
            alive = None
            for step, left in zip(order.tolist(), rest.tolist()):
                if not left:
                    break
                weight, own = lists[step]
                docs, adds = own.part(window)
                if alive is None and left >= bar:
                    score[docs - base] += weight * adds
                    continue
                # what is not yet within reach cannot enter through the lists left
                alive = np.nonzero(score >= bar - left)[0] if alive is None else alive[score[alive] >= bar - left]
                if not len(alive):
                    break
                at = np.minimum(np.searchsorted(docs, alive + base), len(docs) - 1)
                met = docs[at] == alive + base
                score[alive[met]] += weight * adds[at[met]]
            found = np.nonzero(score >= bar)[0] if alive is None else alive[score[alive] >= bar]
            if len(found):
                query.offer(k, score[found], self.doc_id[found + base], self.known[found + base])
                bar = max(bar, query.bar(k))


def _chunks(batches: Iterator[pa.RecordBatch], documents: int, terms: int) -> Iterator[Chunk]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column("terms").flatten())
        if size >= POSTINGS:
            yield Chunk(held, documents, terms)
            held, size = [], 0
    if held:
        yield Chunk(held, documents, terms)


def _blocks(queries: DataFrame, block_chars: int) -> Iterator[list]:
    """The queries with their terms, in blocks of about ``block_chars`` characters whatever their number."""
    rows = written(queries.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")), "queries")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    numbered = rows.withColumn("number", F.monotonically_increasing_id())
    for block in range(blocks):
        own = numbered.filter(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block)
        yield own.select("number", "item_id", terms_of(F.col("text")).alias("words")).collect()


def _weights(found: DataFrame, documents: int, terms: int) -> dict[int, int]:
    """Weight of every term that occurs, by its place; at most the terms of a block of queries."""
    df = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ratio = (2 * F.lit(documents) + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    return {r.term: r.weight for r in df.select("term", F.floor(1000 * F.log(ratio)).alias("weight")).collect()}


def search(documents: DataFrame, queries: DataFrame, k: int = 10, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``k`` best documents with a score above 0 of every query.

    ``documents`` has doc_id and text, ``queries`` item_id and text; both ids are integers or null.
    """
    spark = documents.sparkSession
    ranked = None
    for rows in _blocks(queries, block_chars):
        terms = sorted({word for row in rows for word in row.words})
        if not terms:
            continue
        place = {term: i for i, term in enumerate(terms)}
        found = written(bags(documents, terms), "bags")
        size = found.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
        weights = _weights(found, size.documents, size.terms) if size.documents else {}
        asked = []
        for row in rows:
            own = {place[word]: n for word, n in Counter(row.words).items() if weights.get(place[word])}
            asked.append((row.number, row.item_id, list(own), [weights[t] * n for t, n in own.items()]))
        shared = spark.sparkContext.broadcast((asked, size.documents, size.terms))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked, *counts = shared.value
            own = [Query(terms, weights) for _, _, terms, weights in asked]
            for chunk in _chunks(batches, *counts):
                for query in own:
                    chunk.run(query, k)
            of = pa.array(np.repeat(np.arange(len(own)), [len(query.score) for query in own]))
            doc_id = np.concatenate([q.doc_id for q in own])
            known = np.concatenate([q.known for q in own])
            yield pa.RecordBatch.from_pydict(
                {
                    "number": pa.array([a[0] for a in asked], pa.int64()).take(of),
                    "item_id": pa.array([a[1] for a in asked], pa.int64()).take(of),
                    "doc_id": pa.array(doc_id, mask=~known),
                    "score": pa.array(np.concatenate([q.score for q in own])),
                    "part": pa.array(np.full(len(doc_id), TaskContext.get().partitionId() % GROUPS)),
                }
            )

        lists = found.mapInArrow(run, "number long, item_id long, doc_id long, score long, part long")
        best = _best(_best(lists, ["number", "part"], k), ["number"], k)
        ranked = best if ranked is None else ranked.unionByName(best)
    if ranked is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return ranked.select("item_id", "rank", "doc_id", "score")


def _best(lists: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
