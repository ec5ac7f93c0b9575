"""Exact best dot products of vectors inside one task, without forming every cell.

Columns are laid out in leaves of near vectors, each with its centre and radius. For a row ``u`` no column of a leaf scores
above ``u . centre + |u| radius`` nor above ``|u|`` times its longest vector, so rows, in groups of similar direction, visit the leaves in falling order of that bound
and stop when it is below their k-th best score. Where bounds do not help, every cell is formed once and compared once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np

LEAF, GROUP = 256, 256
_MOST_LEAVES = 32


def near_order(vectors: np.ndarray, size: int, lengths: np.ndarray | None = None) -> np.ndarray:
    """Places of ``vectors`` by repeated halving along the widest axis; runs of ``size`` places lie near each other.

    With ``lengths`` the longest vectors come first, in shells that double in number.
    """
    order, waiting = np.arange(len(vectors)), [(0, len(vectors))]
    if lengths is not None:
        order = np.argsort(-lengths, kind="stable")
        edges, step = [0], max(1, len(order) // (256 * size)) * size
        while edges[-1] < len(order):
            edges.append(min(len(order), edges[-1] + step))
            step *= 2
        waiting = list(zip(edges[:-1], edges[1:]))
    while waiting:
        low, high = waiting.pop()
        if high - low <= size:
            continue
        own = order[low:high]
        # the axis decides about speed only, so some of the vectors are enough to choose it
        axis = int(np.argmax(np.var(vectors[own[:: max(1, len(own) // 2000)]], axis=0)))
        middle = math.ceil((high - low) / size) // 2 * size
        order[low:high] = own[np.argpartition(vectors[own, axis], middle)]
        waiting += [(low, low + middle), (low + middle, high)]
    return order


class Columns:
    """Column ids and vectors in leaves. ``place`` gives a column's place in the order of ids; see :func:`best_of_rows`."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.sorted_ids = ids[by_id]
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        order = near_order(vectors, LEAF, lengths)
        count, leaves = len(order), math.ceil(len(order) / LEAF)
        padded = np.append(order, np.repeat(order[-1:], leaves * LEAF - count))
        self.count, self.leaves = count, leaves
        self.ids = ids[padded]
        self.vectors = vectors[padded].reshape(leaves, LEAF, -1)
        self.centres = self.vectors.mean(axis=1)
        self.radii = np.sqrt(((self.vectors - self.centres[:, None]) ** 2).sum(axis=2).max(axis=1))
        # room for the rounding of sums
        self.radii = self.radii * (1 + 1e-12) + 1e-12 * np.sqrt((self.centres**2).sum(axis=1))
        self.longest = lengths[padded].reshape(leaves, LEAF).max(axis=1) * (1 + 1e-12)
        place = np.empty(count, np.int64)
        place[order] = np.arange(count)
        self.place_by_id = place[by_id]

    def places(self, ids: np.ndarray) -> np.ndarray:
        """Places of columns, -1 for those that are not here."""
        at = np.minimum(np.searchsorted(self.sorted_ids, ids), self.count - 1)
        return np.where(self.sorted_ids[at] == ids, self.place_by_id[at], -1)


def _first_of_rows(row: np.ndarray, place: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int, digits: int):
    """The first ``k`` cells of each row by rounded score and column id, and their rounded scores."""
    shown = np.round(score, digits)
    order = np.lexsort((ids[place], -shown, row))
    row = row[order]
    order = order[np.arange(len(row)) - np.searchsorted(row, row, "left") < k]
    return order, shown[order]


def _best_of_group(columns: Columns, rows: np.ndarray, k: int, digits: int, above: float | None, skip_row, skip_place):
    """Row numbers, places and scores of the best ``k`` columns of a group of rows."""
    unit = 10.0**-digits
    size = len(rows)
    lengths = np.sqrt((rows * rows).sum(axis=1))[:, None]
    bound = np.minimum(rows @ columns.centres.T + lengths * columns.radii, lengths * columns.longest)
    limit = np.full(size, -np.inf if above is None else above - unit)
    highest = bound.max(axis=0)
    waiting = np.argsort(-highest, kind="stable")
    kept = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    slot, inside = np.full(columns.leaves, -1), np.full(size, -1)
    width, padding = 4, columns.leaves * LEAF - columns.count
    while len(waiting) and not highest[waiting[0]] < limit.min():
        now, waiting = waiting[:width], waiting[width:]
        here = np.flatnonzero(~(bound[:, now] < limit[:, None]).all(axis=1))
        if len(here):
            tile = rows[here] @ columns.vectors[now].reshape(-1, rows.shape[1]).T
            slot[now], inside[here] = np.arange(len(now)), np.arange(len(here))
            if padding and slot[-1] >= 0:
                end = (slot[-1] + 1) * LEAF
                tile[:, end - padding : end] = -np.inf
            if len(skip_row):
                at, of = slot[skip_place // LEAF], inside[skip_row]
                met = (at >= 0) & (of >= 0)
                tile[of[met], at[met] * LEAF + skip_place[met] % LEAF] = -np.inf
            wanted = tile >= limit[here][:, None]
            if k < tile.shape[1] and np.count_nonzero(wanted) > 8 * k * len(here):
                edge = np.partition(tile, tile.shape[1] - k, axis=1)[:, tile.shape[1] - k]
                limit[here] = np.maximum(limit[here], np.round(edge, digits) - unit)
                wanted = tile >= limit[here][:, None]
            row, cell = np.nonzero(wanted)
            score = tile[row, cell]
            real = score > -np.inf
            if above is not None:
                real &= np.round(score, digits) > above
            row, cell, score = row[real], cell[real], score[real]
            if len(row):
                found = here[row], now[cell // LEAF] * LEAF + cell % LEAF, score
                kept = tuple(np.concatenate(both) for both in zip(kept, found))
                first, shown = _first_of_rows(*kept, columns.ids, k, digits)
                kept = tuple(part[first] for part in kept)
                ends = np.searchsorted(kept[0], np.arange(size), "right")
                full = np.flatnonzero(np.diff(ends, prepend=0) == k)
                limit[full] = np.maximum(limit[full], shown[ends[full] - 1] - unit)
            slot[now], inside[here] = -1, -1
        if width < _MOST_LEAVES:
            width *= 2
            waiting = waiting[~(bound[:, waiting] < limit[:, None]).all(axis=0)]
    return kept


def _smallest_ids(columns: Columns, size: int, k: int, skip_row: np.ndarray, skip_place: np.ndarray):
    """The same for rows of zeros, whose scores are all equal: the smallest ids that are not skipped."""
    most = k + (int(np.bincount(skip_row).max()) if len(skip_row) else 0)
    listed = columns.place_by_id[:most]
    free = np.ones((size, len(listed)), bool)
    order = np.argsort(listed)
    at = np.minimum(np.searchsorted(listed[order], skip_place), len(listed) - 1)
    met = listed[order[at]] == skip_place
    free[skip_row[met], order[at[met]]] = False
    row, cell = np.nonzero(free & (np.cumsum(free, axis=1) <= k))
    return row, listed[cell], np.zeros(len(row))


def best_of_rows(
    row_vectors: np.ndarray, columns: Columns, k: int, digits: int, above: float | None, skip_row: np.ndarray, skip_place: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers, column ids and scores of up to ``k`` best columns per row, by rounded score, then id.

    ``skip_row`` (ascending) and ``skip_place`` name cells that never show up; ``above`` keeps larger rounded scores only.
    """
    lengths = np.sqrt((row_vectors * row_vectors).sum(axis=1))
    zero, usable = np.flatnonzero(lengths == 0), np.flatnonzero(lengths > 0)
    groups = []
    if len(usable):
        order = usable[near_order(row_vectors[usable] / lengths[usable, None], GROUP)]
        groups += [(order[at : at + GROUP], False) for at in range(0, len(order), GROUP)]
    if above is None or above < 0:
        groups += [(zero[at : at + GROUP], True) for at in range(0, len(zero), GROUP)]
    for own, is_zero in groups:
        low, high = np.searchsorted(skip_row, own, "left"), np.searchsorted(skip_row, own, "right")
        counts = high - low
        ends = np.cumsum(counts)
        at = np.arange(ends[-1]) + np.repeat(low - (ends - counts), counts)
        skipped = np.repeat(np.arange(len(own)), counts), skip_place[at]
        if is_zero:
            row, place, score = _smallest_ids(columns, len(own), k, *skipped)
        else:
            row, place, score = _best_of_group(columns, row_vectors[own], k, digits, above, *skipped)
        yield own[row], columns.ids[place], score
