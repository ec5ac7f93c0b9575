"""Hard negatives of anchors: tiles of exact integer scores by recursive multiplication, merged through bounded heaps.

Anchors are handed to the tasks in blocks of a fixed size; every task multiplies a block with tiles of the candidates it
reads. A first pass keeps each anchor's best rows of its own label, a second the best rows of other labels in the score
window of each positive. Both keep lists of fixed length that merge in any order, so nothing else leaves a task, no label
is a shuffle key, and a label with a third of all rows is spread as it is stored.

Rows with a null label, a null vector, or a null or non-finite component take no part, nor do rows with a component of
``LARGEST`` / 256 or more in size, whose scores might not fit 64 bits. Vectors of different lengths count as padded with
zeros; an empty one scores zero with all. Repeated rows are rows of their own: each has its own place in the lists and, as
an anchor, its own results; only the anchor's own row is left out. Equal scores go by smaller id, null ids last; rows equal
in both by their order in the written table. A row whose ``is_anchor`` is null is no anchor. An empty table, or one without
anchors, gives no rows. Columns other than the four named are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Bytes of the vectors of one broadcast block of anchors.
BLOCK_BYTES = 32 << 20
#: Candidates and anchors of one product.
TILE, STRIP = 4_096, 1_024
#: Sides up to this size are multiplied directly.
DIRECT = 16
#: Integer components are below this size in absolute value: a hundred scores of 80,000 components fit 64 bits.
LARGEST = 1 << 20

_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right`` of int64 matrices by seven half-size products; odd sides are padded with zeros.

    Additions wrap modulo 2^64, so the result is exact whenever it fits, whatever the intermediate sums.
    """
    rows, depth = left.shape
    cols = right.shape[1]
    if min(rows, depth, cols) <= DIRECT:
        return np.einsum("ik,kj->ij", left, right)  # several times faster than matmul on integers
    if rows % 2 or depth % 2 or cols % 2:
        left = np.pad(left, ((0, rows % 2), (0, depth % 2)))
        right = np.pad(right, ((0, depth % 2), (0, cols % 2)))
    m, k, n = left.shape[0] // 2, left.shape[1] // 2, right.shape[1] // 2
    a, b, c, d = left[:m, :k], left[:m, k:], left[m:, :k], left[m:, k:]
    e, f, g, h = right[:k, :n], right[:k, n:], right[k:, :n], right[k:, n:]
    p1 = product(a + d, e + h)
    p2 = product(c + d, e)
    p3 = product(a, f - h)
    p4 = product(d, g - e)
    p5 = product(a + b, h)
    p6 = product(c - a, e + f)
    p7 = product(b - d, g + h)
    whole = np.empty((2 * m, 2 * n), np.int64)
    whole[:m, :n] = p1 + p4 - p5 + p7
    whole[:m, n:] = p3 + p5
    whole[m:, :n] = p2 + p4
    whole[m:, n:] = p1 - p2 + p3 + p6
    return whole[:rows, :cols]


@dataclass
class Rows:
    """Vectors with their rows, ids (``known`` is false for null) and labels."""

    row: np.ndarray
    vec_id: np.ndarray
    known: np.ndarray
    label: np.ndarray
    vector: np.ndarray

    @classmethod
    def of(cls, batch, width: int) -> Rows:
        lists = batch.column("vector")
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        vector = np.zeros((len(sizes), width), np.int64)
        vector[np.arange(width) < sizes[:, None]] = flat
        ids = batch.column("vec_id")
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        numbers = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "label")]
        return cls(numbers[0], ids.fill_null(0).to_numpy(zero_copy_only=False), known, numbers[1], vector)

    def take(self, at: np.ndarray) -> Rows:
        return Rows(self.row[at], self.vec_id[at], self.known[at], self.label[at], self.vector[at])

    def in_order(self) -> Rows:
        return self.take(np.lexsort((self.row, self.vec_id, ~self.known)))


class Heaps:
    """The ``k`` best candidates of each of ``n`` lists: higher score first, then smaller id, then row."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), _LOW)
        self.row = np.zeros((n, k), np.int64)
        self.vec_id = np.zeros((n, k), np.int64)
        self.known = np.zeros((n, k), bool)
        self.held = np.zeros((n, k), bool)

    @property
    def bar(self) -> np.ndarray:
        """Score below which nothing can enter each list."""
        return self.score[:, -1]

    def merge(self, lists: np.ndarray, score: np.ndarray, row: np.ndarray, vec_id: np.ndarray, known: np.ndarray) -> None:
        """Offer candidates, given with the number of their list; every list keeps its best."""
        touched = np.unique(lists)
        old = self.held[touched]
        at = np.broadcast_to(touched[:, None], old.shape)[old]
        held = [np.concatenate([getattr(self, name)[touched][old], new]) for name, new in (("score", score), ("row", row), ("vec_id", vec_id), ("known", known))]
        at = np.concatenate([at, lists])
        order = np.lexsort((held[1], held[2], ~held[3], ~held[0], at))
        at = at[order]
        place = np.arange(len(at)) - np.searchsorted(at, at, "left")
        kept = place < self.k
        at, place, order = at[kept], place[kept], order[kept]
        for name, values in zip(("score", "row", "vec_id", "known"), held):
            getattr(self, name)[at, place] = values[order]
        self.held[at, place] = True


def _tiles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Rows]:
    """The task's candidates in tiles, each in order of id."""
    waiting, count = [], 0
    for batch in batches:
        waiting.append(batch)
        count += len(batch)
        while count >= TILE:
            table = pa.Table.from_batches(waiting).combine_chunks()
            yield Rows.of(table.slice(0, TILE).combine_chunks().to_batches()[0], width).in_order()
            waiting, count = table.slice(TILE).to_batches(), count - TILE
    if count:
        yield Rows.of(pa.Table.from_batches(waiting).combine_chunks().to_batches()[0], width).in_order()


def best_of_label(anchors: Rows, batches: Iterator[pa.RecordBatch], k: int) -> Heaps:
    """The best ``k`` other rows of each anchor's label among the candidates."""
    heaps = Heaps(len(anchors.row), k)
    for tile in _tiles(batches, anchors.vector.shape[1]):
        for label in np.intersect1d(anchors.label, tile.label):
            own, mine = np.nonzero(anchors.label == label)[0], tile.take(np.nonzero(tile.label == label)[0])
            right = np.ascontiguousarray(mine.vector.T)
            for strip in np.split(own, range(STRIP, len(own), STRIP)):
                score = product(anchors.vector[strip], right)
                r, c = np.nonzero((score >= heaps.bar[strip][:, None]) & (anchors.row[strip][:, None] != mine.row))
                heaps.merge(strip[r], score[r, c], mine.row[c], mine.vec_id[c], mine.known[c])
    return heaps


def best_in_windows(anchors: Rows, low: np.ndarray, high: np.ndarray, batches: Iterator[pa.RecordBatch], k: int) -> Heaps:
    """The best ``k`` rows of other labels for each anchor and window ``low`` to ``high`` (anchors x windows, ends included)."""
    n, windows = low.shape
    heaps = Heaps(n * windows, k)
    for tile in _tiles(batches, anchors.vector.shape[1]):
        right = np.ascontiguousarray(tile.vector.T)
        for strip in np.split(np.arange(n), range(STRIP, n, STRIP)):
            score = product(anchors.vector[strip], right)
            least = np.maximum(low[strip], heaps.bar.reshape(n, windows)[strip])
            # an empty window, or one no score of which can enter, must not widen the others
            open_ = least <= high[strip]
            lower = np.where(open_, least, _HIGH).min(axis=1)[:, None]
            upper = np.where(open_, high[strip], _LOW).max(axis=1)[:, None]
            r, c = np.nonzero((score >= lower) & (score <= upper) & (anchors.label[strip][:, None] != tile.label))
            value = score[r, c]
            for w in range(windows):
                fits = np.nonzero((value >= least[r, w]) & (value <= high[strip][r, w]))[0]
                at = c[fits]
                heaps.merge(strip[r[fits]] * windows + w, value[fits], tile.row[at], tile.vec_id[at], tile.known[at])
    return heaps


def integer_vectors(rows: DataFrame) -> DataFrame:
    """row, vec_id, label, vector (array<long>: floor of 256 times each component) and is_anchor of the rows that take part."""
    sound = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < LARGEST / 256)
    whole = lambda x: F.floor(x.cast("double") * 256).cast("long")
    taking = rows.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", sound))
    return taking.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long"),
        F.col("label").cast("long"),
        F.transform("vector", whole).alias("vector"),
        F.coalesce("is_anchor", F.lit(False)).alias("is_anchor"),
    )


def _lists(found: DataFrame, k: int) -> DataFrame:
    """The tasks' lists merged: the best ``k`` of each anchor (and positive), with their rank."""
    order = [F.desc("score"), F.col("vec_id").asc_nulls_last(), "candidate"]
    best = Window.partitionBy("anchor", "positive").orderBy(*order)
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _report(heaps: Heaps, columns: dict[str, pa.Array | np.ndarray]) -> pa.RecordBatch:
    """The held candidates as rows; ``columns`` has a value for each list."""
    lists, place = np.nonzero(heaps.held)
    shown = {name: (values.take(pa.array(lists)) if isinstance(values, pa.Array) else pa.array(values[lists])) for name, values in columns.items()}
    vec_id = pa.array(heaps.vec_id[lists, place], mask=~heaps.known[lists, place])
    shown |= {"candidate": pa.array(heaps.row[lists, place]), "vec_id": vec_id, "score": pa.array(heaps.score[lists, place])}
    return pa.RecordBatch.from_pydict(shown)


_FOUND = "anchor long, positive long, candidate long, vec_id long, score long"
_MINED = "anchor long, positive long, anchor_id long, positive_id long, positive_score long, candidate long, vec_id long, score long"


def mine(
    rows: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of every anchor of ``rows``.

    ``rows`` has vec_id, label, vector (array of numbers) and is_anchor. Each anchor's first ``positives`` rows of its
    label are paired with the first ``negatives`` rows of other labels whose score is ``low`` to ``high`` per cent of theirs.
    """
    spark = rows.sparkSession
    vectors = written(integer_vectors(rows), "vectors")
    shape = vectors.agg(F.count_if("is_anchor").alias("n"), F.max(F.size("vector")).alias("width")).first()
    width = max(shape.width or 0, 1)
    blocks = max(1, -(-shape.n * 8 * width // block_bytes))
    candidates = vectors.select("row", "vec_id", "label", "vector")
    block_of = F.pmod(F.xxhash64("row"), F.lit(blocks))
    mined = None
    for block in range(blocks):
        # one block of bounded size at a time
        table = candidates.join(vectors.filter(F.col("is_anchor") & (block_of == block)).select("row"), "row", "left_semi").toArrow()
        if not len(table):
            continue
        anchors = Rows.of(table.combine_chunks().to_batches()[0], width)
        shared = spark.sparkContext.broadcast(anchors)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            heaps = best_of_label(own, batches, positives)
            yield _report(heaps, {"anchor": own.row, "positive": np.zeros_like(own.row)})

        best = _lists(candidates.mapInArrow(find, _FOUND), positives).orderBy("anchor", "rank").toArrow()
        windows = spark.sparkContext.broadcast(_windows(anchors, best, positives, low, high))

        def search(batches: Iterator[pa.RecordBatch], shared=shared, windows=windows) -> Iterator[pa.RecordBatch]:
            bounds, columns = windows.value
            heaps = best_in_windows(shared.value, *bounds, batches, negatives)
            yield _report(heaps, columns)

        found = written(_lists(candidates.mapInArrow(search, _MINED), negatives), f"negatives-{block}")
        shared.unpersist()
        windows.unpersist()
        mined = found if mined is None else mined.unionByName(found)
    if mined is None:
        mined = spark.createDataFrame([], _MINED + ", rank int")
    return mined.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _windows(anchors: Rows, best: pa.Table, positives: int, low: int, high: int):
    """Bounds of the windows (anchors x positives; low above high where there is none), and what a mined row shows of its list."""
    order = np.argsort(anchors.row)
    anchor = order[np.searchsorted(anchors.row[order], best.column("anchor").to_numpy())]
    place = best.column("rank").to_numpy() - 1
    score = best.column("score").to_numpy()
    lower, upper = np.full((len(order), positives), _HIGH), np.full((len(order), positives), _LOW)
    lower[anchor, place] = -(-low * score // 100)
    upper[anchor, place] = high * score // 100
    lists = np.full(len(order) * positives, -1)
    lists[anchor * positives + place] = np.arange(len(score))
    at = pa.array(lists, mask=lists < 0)
    each = np.repeat(np.arange(len(order)), positives)
    pick = lambda name: best.column(name).combine_chunks().take(at)
    columns = {
        "anchor": anchors.row[each],
        "positive": pick("candidate"),
        "anchor_id": pa.array(anchors.vec_id[each], mask=~anchors.known[each]),
        "positive_id": pick("vec_id"),
        "positive_score": pick("score"),
    }
    return (lower, upper), columns
