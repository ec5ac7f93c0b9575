import numpy as np
import pytest

from loanweave.operators import vector_search as vs


def listed(rows, ids, vectors, k, above, skipped):
    out = set()
    for at, row in enumerate(rows):
        scores = {int(i): round(float(row @ x), 9) for i, x in zip(ids, vectors) if (at, int(i)) not in skipped}
        order = sorted((i for i, s in scores.items() if above is None or s > above), key=lambda i: (-scores[i], i))
        out |= {(at, i) for i in order[:k]}
    return out


@pytest.mark.parametrize("whole_numbers", [False, True])
@pytest.mark.parametrize("above", [None, 0.5, -0.5])
@pytest.mark.parametrize("skips", [0, 400])
def test_best_of_rows(monkeypatch, whole_numbers, above, skips):
    monkeypatch.setattr(vs, "LEAF", 16)
    rng = np.random.default_rng(3)
    rows, vectors = rng.normal(size=(90, 3)), rng.normal(size=(500, 3))
    if whole_numbers:  # many equal scores, and vectors of zeros
        rows, vectors = np.round(rows), np.round(vectors)
    rows[::9] = 0
    ids = rng.permutation(2000)[:500]
    columns = vs.Columns(ids, vectors)
    skip_row, skip_id = np.sort(rng.integers(0, 90, skips)), ids[rng.integers(0, 500, skips)]
    found = set()
    for row, col, score in vs.best_of_rows(rows, columns, 5, 9, above, skip_row, columns.places(skip_id)):
        pairs = set(zip(row.tolist(), col.tolist()))
        assert len(pairs) == len(row) and not pairs & found
        found |= pairs
        place = columns.places(col)
        assert np.allclose(score, (rows[row] * columns.vectors.reshape(-1, 3)[place]).sum(axis=1))
    assert found == listed(rows, ids, vectors, 5, above, set(zip(skip_row.tolist(), skip_id.tolist())))


def test_few_cells_are_formed(monkeypatch):
    rng = np.random.default_rng(4)
    rows, vectors = rng.normal(size=(512, 4)), rng.normal(size=(100_000, 4))
    columns, formed, whole = vs.Columns(np.arange(100_000), vectors), [], np.nonzero
    monkeypatch.setattr(vs.np, "nonzero", lambda tile: formed.append(tile.size) or whole(tile))
    list(vs.best_of_rows(rows, columns, 10, 9, None, np.zeros(0, int), np.zeros(0, int)))
    assert sum(formed) < 512 * 100_000 // 10
