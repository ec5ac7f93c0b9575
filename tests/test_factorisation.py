import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanweave.operators import factorisation as cmf
from loanweave.operators import routing
from loanweave import session

CONFIG = cmf.CMFConfig(factors=4, iterations=1, alpha=3.0, regularization=0.1)
SIZES = {"item": 9, "author": 4, "publisher": 3, "subject": 6}


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    users = 12
    matrices = {}
    for side, n in SIZES.items():
        matrix = np.round(rng.random((users, n)) * 3, 2) * (rng.random((users, n)) < 0.5)
        matrix[3] = 0  # a user without entries
        matrix[:, n - 1] = 0  # a feature without entries
        matrices[side] = matrix
    matrices["author"][5] = 0  # present in some sides only
    matrices["item"][:3, 0] = 1.0
    rows = [
        (side, int(u), int(f), float(m[u, f])) for side, m in matrices.items() for u, f in zip(*np.nonzero(m))
    ]
    entries = spark.createDataFrame(rows, "side string, u long, feature long, r double").cache()
    user_factors = rng.normal(size=(users, 4))
    side_factors = {side: rng.normal(size=(n, 4)) for side, n in SIZES.items()}
    users_frame = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(user_factors)], "id long, features array<double>")
    sides_frame = spark.createDataFrame(
        [(side, n, v.tolist()) for side, f in side_factors.items() for n, v in enumerate(f)],
        "side string, id long, features array<double>",
    )
    return entries, matrices, user_factors, side_factors, users_frame, sides_frame


def side_update(matrix, fixed, weight, c):
    out = np.zeros((matrix.shape[1], 4))
    for f in range(matrix.shape[1]):
        own = np.nonzero(matrix[:, f])[0]
        if len(own):
            x, conf = fixed[own], c(matrix[own, f])
            a = fixed.T @ fixed + (x.T * (conf - 1)) @ x + CONFIG.regularization * weight * np.eye(4)
            out[f] = np.linalg.solve(a, x.T @ conf)
    return out


def user_update(matrices, factors, weights, c, users=12):
    out = np.zeros((users, 4))
    for u in range(users):
        a, b = CONFIG.regularization * np.eye(4), np.zeros(4)
        for side, matrix in matrices.items():
            own = np.nonzero(matrix[u])[0]
            if len(own):
                x, conf = factors[side][own], c(matrix[u, own])
                a += weights[side] * (factors[side].T @ factors[side] + (x.T * (conf - 1)) @ x)
                b += weights[side] * (x.T @ conf)
        out[u] = np.linalg.solve(a, b)
    return out


def shifted(r):
    return 1 + CONFIG.alpha * r


@pytest.mark.parametrize("part_entries", [10**6, 2])
def test_half_steps(spark, data, part_entries):
    entries, matrices, user_factors, side_factors, users, sides = data
    weighted = cmf.with_confidence(entries, CONFIG.alpha)
    step = cmf.lay_out(weighted, False, part_entries)
    assert step.split_targets == (part_entries == 2)
    found = {(r.side, r.id): r.features for r in cmf.update_sides(step, users, CONFIG).collect()}
    for side, weight in CONFIG.weights().items():
        wanted = side_update(matrices[side], user_factors, weight, shifted)
        for f in range(SIZES[side]):
            assert np.allclose(found.get((side, f), np.zeros(4)), wanted[f], atol=1e-9)
    step = cmf.lay_out(weighted, True, part_entries)
    solved = {r.id: r.features for r in cmf.update_users(step, sides, CONFIG).collect()}
    wanted = user_update(matrices, side_factors, CONFIG.weights(), shifted)
    assert 3 not in solved
    for u in range(12):
        assert np.allclose(solved.get(u, np.zeros(4)), wanted[u], atol=1e-9)


def test_loss(spark, data):
    entries, matrices, user_factors, side_factors, users, sides = data
    total = CONFIG.regularization * (np.sum(user_factors**2) + sum(np.sum(f**2) for f in side_factors.values()))
    for side, weight in CONFIG.weights().items():
        for u, f in zip(*np.nonzero(matrices[side])):
            error = 1 - user_factors[u] @ side_factors[side][f]
            total += weight * shifted(matrices[side][u, f]) * error**2
    found = cmf.loss(cmf.with_confidence(entries, CONFIG.alpha), users, sides, CONFIG).first()[0]
    assert abs(found - total) < 1e-8


def test_prediction_folds_into_item_vectors(spark, data):
    _, _, user_factors, side_factors, users, sides = data
    codes = [(i, i % 4, i % 3) for i in range(9)]
    weights = [(i, s, 0.2 + 0.1 * s) for i in range(8) for s in range(i % 3, 6, 2)]
    items = spark.createDataFrame(codes, "i long, author_code long, publisher_code long")
    subjects = spark.createDataFrame(weights, "i long, subject_idx long, weight double")
    dense = np.zeros((9, 6))
    for i, s, w in weights:
        dense[i, s] = w
    scores = user_factors @ side_factors["item"].T
    scores += 0.3 * (user_factors @ side_factors["author"].T)[:, [c[1] for c in codes]]
    scores += 0.2 * (user_factors @ side_factors["publisher"].T)[:, [c[2] for c in codes]]
    scores += 0.2 * (user_factors @ side_factors["subject"].T @ dense.T) / (dense.sum(axis=1) + 1e-8)
    vectors = cmf.item_vectors(items, sides, 4, subjects)
    folded = {r.i: np.array(r.features) for r in vectors.collect()}
    assert all(np.allclose(user_factors @ folded[i], scores[:, i]) for i in range(9))
    mean, deviation = cmf.score_moments(users, vectors, 4)
    assert abs(mean - scores.mean()) < 1e-9 and abs(deviation - scores.std()) < 1e-9


def test_blend(spark, data):
    _, _, user_factors, side_factors, users, sides = data
    rng = np.random.default_rng(5)
    ue, ie = rng.normal(size=(12, 3)), rng.normal(size=(9, 3))
    ue[2], ie[4] = 0, 0
    scores = user_factors @ side_factors["item"].T
    cosine = (ue / (np.linalg.norm(ue, axis=1, keepdims=True) + 1e-8)) @ (ie / (np.linalg.norm(ie, axis=1, keepdims=True) + 1e-8)).T
    wanted = (scores - scores.mean()) / scores.std() + 0.4 * (cosine - cosine.mean()) / cosine.std()

    def vectors(matrix, key, name):
        return spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(matrix)], f"{key} long, {name} array<double>")

    left, right, shift = cmf.blended_vectors(
        vectors(user_factors, "u", "features"),
        vectors(side_factors["item"], "i", "features"),
        4,
        vectors(ue, "u", "embedding"),
        vectors(ie, "i", "embedding"),
        3,
        0.4,
    )
    for row in cmf.predict_topk(left, right, 9).collect():
        assert abs(row.score - shift - wanted[row.u, row.i]) < 1e-6


@pytest.mark.parametrize("how,c", [("shifted", shifted), ("scaled", lambda r: 3.0 * r), ("raw", lambda r: r)])
def test_fit_one_iteration(spark, data, how, c):
    entries, matrices, *_ = data
    ids = spark.range(12)
    start = {r.id: np.array(r.features) for r in cmf.init_factors(ids, "user", 4, 42).collect()}
    start = np.stack([start[u] for u in range(12)])
    fitted = cmf.fit(entries, CONFIG, users=ids, how=how, report_loss=True)
    sides = {side: side_update(matrices[side], start, w, c) for side, w in CONFIG.weights().items()}
    users = user_update(matrices, sides, CONFIG.weights(), c)
    for row in fitted.users.collect():
        assert np.allclose(row.features, users[row.id], atol=1e-3)
    for row in fitted.sides.collect():
        assert np.allclose(row.features, sides[row.side][row.id], atol=1e-4)
    assert len(fitted.losses) == 1


def test_init_is_normal_and_layout_free(spark):
    one = cmf.init_factors(spark.range(0, 4000, 1, 1), "user", 16, 42).orderBy("id").collect()
    two = cmf.init_factors(spark.range(0, 4000, 1, 7), "user", 16, 42).orderBy("id").collect()
    assert one == two
    values = np.array([r.features for r in one]).ravel() * 4.0
    assert abs(values.mean()) < 0.02 and abs(values.std() - 1) < 0.02
    assert abs((values**4).mean() - 3) < 0.15


def test_optional_sides(spark, data):
    entries = data[0].filter(F.col("side") == "item")
    fitted = cmf.fit(entries, CONFIG)
    assert {r.side for r in fitted.sides.select("side").distinct().collect()} == {"item"}


def test_models_share_passes(spark, data):
    """Several models fitted in one pass equal the same models fitted alone, losses included."""
    configs = [cmf.CMFConfig(factors=n, iterations=2, alpha=3.0, regularization=reg, random_state=n) for n, reg in ((4, 0.1), (3, 0.3))]
    configs.append(cmf.CMFConfig(factors=2, iterations=1, alpha=5.0))
    together = cmf.fit_many(data[0], configs, report_loss=True)
    for config, found in zip(configs, together):
        alone = cmf.fit(data[0], config, report_loss=True)
        rows = lambda frame, *keys: sorted((*[r[k] for k in keys], tuple(np.round(r.features, 4))) for r in frame.collect())
        assert rows(found.users, "id") == rows(alone.users, "id")
        assert rows(found.sides, "side", "id") == rows(alone.sides, "side", "id")
        assert np.allclose(found.losses, alone.losses, rtol=1e-5)


def test_no_exchange_carries_a_vector_per_entry(spark, data):
    """Vectors leave the routing join once per part that lists them."""
    entries = data[0]
    parts = cmf.lay_out(cmf.with_confidence(entries, 3.0), False)
    sent = parts.routed(data[4].select(F.lit(0).alias("bit"), F.col("id").alias("other"), "features"))
    assert sent.count() == sent.select("part", "slot").distinct().count() < entries.count()


def test_parts_arrive_as_partitions_with_few_columns(spark):
    rows = [(k, t, b, o, 1.0 + t + o, float(o % 2)) for k in (-1, 2) for t in range(6) for b in (0, 3) for o in range(t + 1)]
    entries = spark.createDataFrame(rows, "kind int, target long, bit int, other long, c double, p double")
    for limit in (500, 4):
        parts = routing.lay_out(entries, limit)
        assert parts.split_targets == (limit == 4)
        listed = {(r.part, r.slot): (r.bit, r.other) for r in parts.routes.collect()}
        found = [
            (r.kind, r.target, *listed[r.part, slot], c, float(p))
            for r in parts.runs.collect()
            for slot, c, p in zip(*routing.run_arrays(r.slots, r.c, r.p))
        ]
        assert sorted(found) == sorted(rows)
        parts.discard()
    plain = {"code": [5 << 32 | 3 << 16 | 1 << 8 | 1] * 2, "target": [7, 7], "other": [4, 9], "c": [1.0, 2.0]}
    block = routing._block(pa.table(plain))
    assert block.column("part").to_pylist() == [5, 5, 5] and block.column("kind").to_pylist() == [2, None, None]


def test_parts_are_sent_in_rounds_and_leave_no_files(spark, data, monkeypatch, tmp_path):
    """The bytes sent at a time are bounded, old factors and entries go, and the fit is the same."""
    config = cmf.CMFConfig(factors=4, iterations=3, alpha=3.0, regularization=0.1)
    once = cmf.fit(data[0], config, report_loss=True)
    shown = lambda fitted: [sorted((*r[:-1], *np.round(r.features, 4)) for r in f.collect()) for f in (fitted.users, fitted.sides)]
    rounds, ran = routing.Parts.rounds, []
    monkeypatch.setattr(routing.Parts, "rounds", lambda self, width: ran.append(rounds(self, width)) or ran[-1])
    monkeypatch.setattr(routing, "ROUND_BYTES", 1_000)
    monkeypatch.setattr(routing, "ROUND_ENTRIES", 20)
    folder = tmp_path / "kept"
    monkeypatch.setattr(routing, "ensure_checkpoint_dir", lambda spark: f"file://{folder}")
    again = cmf.fit(data[0], config, report_loss=True)
    assert all(len(r) > 1 for r in ran) and len(ran) == 9
    assert shown(again) == shown(once) and np.allclose(again.losses, once.losses)
    assert not list(folder.rglob("*.parquet"))


def test_a_written_frame_leaves_no_shuffle(spark):
    """What a shuffle wrote goes with the query that needed it, and the frame it came from can still be read."""
    left = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    frame = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    for write in (session.cut_lineage, lambda f: session.stored(f)[0]):
        before = left()
        kept = write(frame)
        assert left() <= before
        assert sorted(kept.collect()) == sorted(frame.collect())


def test_weighted_sums_leave_vectors_of_zeros_out(spark):
    entries = spark.createDataFrame([(1, 5, 2.0), (1, 6, 3.0), (2, 6, 1.0)], "target long, other long, weight double")
    vectors = spark.createDataFrame([(5, [1.0, -1.0]), (6, [0.0, 0.0])], "other long, features array<double>")
    assert [(r.target, r.total) for r in routing.weighted_sums(entries, vectors, 2).collect()] == [(1, [2.0, -2.0])]
    vectors = spark.createDataFrame([(5, [1.0, -1.0]), (6, [0.0, float("nan")])], "other long, features array<double>")
    found = {r.target: r.total for r in routing.weighted_sums(entries, vectors, 2).collect()}
    assert np.isnan(found[1][1]) and np.isnan(found[2][1])
