"""Search, test score and submission against numpy on a small fixture."""

import numpy as np

from loanweave.operators import factorisation as cmf
from loanweave.operators import histories, indexing, matrices
from loanweave.plans import features, tuning


def test_best_setting_is_scored_once_on_the_test_split(spark):
    rng = np.random.default_rng(4)
    n_items, k = 12, 5
    loans = [(int(u), int(i), int(t)) for u in range(9) for t, i in enumerate(rng.permutation(n_items)[: 4 + u % 5])]
    loans = spark.createDataFrame(loans, "u long, i long, t long")
    items = spark.createDataFrame(
        [(i, f"Title {i}", f"Author {i % 3}", f"House {i % 2}", f"tag{i % 4} ; tag{i % 2}", None) for i in range(n_items)],
        'i long, Title string, Author string, Publisher string, Subjects string, `ISBN Valid` string',
    )
    labelled = histories.temporal_split(loans).cache()
    catalogue = features.build_catalogue(items, labelled)
    base = cmf.CMFConfig(factors=3, iterations=2, alpha=5.0)
    found = tuning.tune_and_submit(labelled, catalogue, features.all_users(labelled), {"alpha": [2.0, 5.0]}, base, k=k)
    assert [t["alpha"] for t in found.tried] == [2.0, 5.0]
    assert found.best["map_at_k"] == max(t["map_at_k"] for t in found.tried)

    vectors = {r.i: np.array(r.features) for r in found.model.item_vectors.collect()}
    users = {r.u: np.array(r.features) for r in found.model.user_vectors.collect()}
    held = {}
    for row in labelled.filter("split = 'test'").collect():
        held.setdefault(row.u, set()).add(row.i)
    scores = []
    for u, wanted in held.items():
        ranked = sorted(vectors, key=lambda i: (-round(float(users[u] @ vectors[i]), 9), i))[:k]
        hits = [i in wanted for i in ranked]
        gain = sum(sum(hits[: at + 1]) / (at + 1) for at, hit in enumerate(hits) if hit)
        scores.append(gain / min(len(wanted), k))
    assert found.n_users == len(held)
    assert abs(found.test_map - np.mean(scores)) < 1e-9
    assert found.lines.count() == len(users)  # a line holds the whole list of a user


def test_items_without_subjects_are_zero_rows(spark):
    index = spark.createDataFrame([(5, 0), (6, 1), (9, 2)], "i long, item_idx long")
    weights = spark.createDataFrame([(5, 3, 0.5), (5, 4, 0.25), (7, 1, 1.0)], "i long, subject_idx long, weight double")
    rows = indexing.reindex_weights(index, weights).select("i", "item_idx", "subject_idx", "weight").collect()
    assert sorted(map(tuple, rows), key=repr) == [(5, 0, 3, 0.5), (5, 0, 4, 0.25), (6, 1, None, 0.0), (9, 2, None, 0.0)]
    assert tuple(indexing.match_rate(index.select("i"), weights).first()) == (3, 1, 33.3)


def test_users_embeddings_are_made_once_for_all_settings(spark, monkeypatch):
    made = []
    whole = matrices.user_embeddings
    monkeypatch.setattr(matrices, "user_embeddings", lambda *given: made.append(1) or whole(*given))
    loans = spark.createDataFrame([(u, i, 0) for u in range(4) for i in range(6) if (u + i) % 3], "u long, i long, t long")
    ids = [(i,) for i in range(6)]
    items = spark.createDataFrame([(i, f"T {i}", "A", "P", "tag", None) for (i,) in ids], 'i long, Title string, Author string, Publisher string, Subjects string, `ISBN Valid` string')
    catalogue = features.build_catalogue(items, loans)
    embeddings = spark.createDataFrame([(i, [1.0 + i, 6.0 - i]) for (i,) in ids], "i long, embedding array<double>")
    held = spark.createDataFrame([(u, (u + 1) % 6) for u in range(4)], "u long, i long")
    base = cmf.CMFConfig(factors=2, iterations=1, alpha=5.0)
    users = features.all_users(loans)
    tried, _, _ = tuning.grid_search(loans, held, catalogue, users, {"factors": [2]}, base, embeddings, 2, (0.0, 0.8), 2)
    assert len(made) == 1
    for row in tried:
        alone = tuning.train_and_evaluate(loans, held, catalogue, base, users, embeddings, 2, row["w_embedding"], 2)[1]
        assert abs(alone - row["map_at_k"]) < 1e-9
