"""Collective matrix factorisation: user factors shared by item, author, publisher and subject matrices.

Entries are rows ``side, u, feature, r``. Each half-step sends every factor row once to each part of the entries that
needs it and solves the targets of a part in batches; a target with very many entries is summed in parts that are merged
afterwards. A factor row that is absent stands for the zero vector. Several models can share one pass.
"""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as vec
from ..session import cut_lineage, discard, forget, shuffles_dropped, stored
from . import routing
from .blocks import dense_product
from .routing import PART_ENTRIES, Parts

SIDES = ("item", "author", "publisher", "subject")
_MERGE_GROUPS = 256


@dataclass(frozen=True)
class CMFConfig:
    """Hyperparameters (fixed values: the published defaults)."""

    factors: int = 128
    iterations: int = 30
    regularization: float = 0.05
    lambda_author: float = 0.3
    lambda_publisher: float = 0.2
    lambda_subject: float = 0.2
    alpha: float = 40.0
    use_confidence: bool = True
    random_state: int = 42

    def weights(self) -> dict[str, float]:
        return {
            "item": 1.0,
            "author": self.lambda_author,
            "publisher": self.lambda_publisher,
            "subject": self.lambda_subject,
        }

    def as_dict(self) -> dict:
        return asdict(self)


@dataclass(frozen=True)
class ScoreWeights:
    """How much each side counts in a prediction; independent of the training weights."""

    item: float = 1.0
    author: float = 0.3
    publisher: float = 0.2
    subject: float = 0.2


@dataclass
class Factors:
    """``users(id, features)`` and ``sides(side, id, features)``."""

    users: DataFrame
    sides: DataFrame
    size: int
    losses: list[float]


def stack_entries(matrices: dict[str, DataFrame]) -> DataFrame:
    """One entry table from per-side matrices with columns ``u, feature, r`` (``i`` for items)."""
    stacked = None
    for side, matrix in matrices.items():
        feature = "i" if "i" in matrix.columns else "feature"
        rows = matrix.select(
            F.lit(side).alias("side"), "u", F.col(feature).cast("long").alias("feature"), F.col("r").cast("double")
        )
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return stacked


def confidence(r: Column, alpha: float, how: str = "shifted") -> Column:
    """``1 + alpha r``, or without the shift (``scaled``), or the plain weight (``raw``)."""
    if how == "shifted":
        return 1.0 + alpha * r
    return alpha * r if how == "scaled" else r


def with_confidence(entries: DataFrame, alpha: float, how: str = "shifted") -> DataFrame:
    return entries.select(
        "side",
        "u",
        "feature",
        confidence(F.col("r"), alpha, how).alias("c"),
        F.when(F.col("r") > 0, 1.0).otherwise(0.0).alias("p"),
    )


def init_factors(ids: DataFrame, label: str, size: int, seed: int) -> DataFrame:
    """Normal starting vectors drawn from a hash of (seed, label, id, position), the same on any layout."""

    def uniform(position: Column, stream: int) -> Column:
        bits = F.xxhash64(F.lit(seed), F.lit(label), F.col("id"), position, F.lit(stream)).bitwiseAND(F.lit((1 << 52) - 1))
        return (bits + 0.5) / F.lit(float(1 << 52))

    def normal(position: Column) -> Column:
        return F.sqrt(-2.0 * F.log(uniform(position, 1))) * F.cos(2.0 * math.pi * uniform(position, 2))

    scale = 1.0 / math.sqrt(size)
    draws = F.transform(F.sequence(F.lit(1), F.lit(size)), lambda position: normal(position) * scale)
    return ids.select("id", draws.cast("array<float>").alias("features"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def gramians(factors: DataFrame, size: int) -> dict[str, np.ndarray]:
    """``F' F`` per side; partitions add up their own share and one row per side reaches the driver."""

    def partial(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = np.asarray(batch.column("side").to_pylist(), dtype=object)
            rows = _matrix(batch.column("features"), size)
            for side in set(sides):
                own = rows[sides == side]
                sums[side] = sums.get(side, 0.0) + own.T @ own
        for side, total in sums.items():
            yield pa.RecordBatch.from_pydict({"side": [side], "total": [total.ravel().tolist()]})

    found = (
        factors.select("side", F.col("features").cast("array<double>").alias("features"))
        .mapInArrow(partial, "side string, total array<double>")
        .groupBy("side")
        .agg(vec.vector_sum(F.col("total")).alias("total"))
    )
    return {row.side: np.asarray(row.total).reshape(size, size) for row in found.collect()}


def lay_out(entries: DataFrame, by_user: bool, part_entries: int = PART_ENTRIES) -> Parts:
    """Entries (with confidence) in parts by update target, once per fit; ``kind`` is the side of a feature target or -1 for users."""
    number = _side_number()
    if by_user:
        rows = entries.select(F.lit(-1).alias("kind"), F.col("u").alias("target"), number.alias("bit"), F.col("feature").alias("other"), "c", "p")
    else:
        rows = entries.select(number.alias("kind"), F.col("feature").alias("target"), F.lit(0).alias("bit"), F.col("u").alias("other"), "c", "p")
    return routing.lay_out(rows, part_entries)


@dataclass
class Share:
    """The slice of the vectors that one model holds, with its constants.

    ``base`` is the part of the normal matrix that all targets of a side share: the fixed side's Gramian and the ridge
    for feature updates; for users the weighted Gramian of each side (keys 0..3) and the ridge (key -1), added only for
    the sides where the user has entries. ``weights`` scales the entries by the side of their other end.
    """

    start: int
    stop: int
    weights: np.ndarray
    base: dict[int, np.ndarray]
    by_user: bool

    @property
    def size(self) -> int:
        return self.stop - self.start

    def shared(self, kind: int, mask: int) -> np.ndarray:
        if not self.by_user:
            return self.base[kind]
        return self.base[-1] + sum(self.base[bit] for bit in range(len(SIDES)) if mask >> bit & 1)


_SOLVED = "kind int, target long, mask int, features array<double>, a array<double>, b array<double>"
_BATCH = 256


def solve(parts: Parts, vectors: DataFrame, shares: list[Share]) -> DataFrame:
    """New vectors ``kind, target, features`` from one pass over the entries, for all models at once.

    ``vectors`` has ``bit, other, features``, the models' factors one after the other. Normal equations are solved in
    batches; those of a target in several parts are added up first.
    """
    width = sum(share.size for share in shares)

    def run(runs: pa.Table, routed: pa.Table) -> pa.Table:
        rows, bits = routing.listed_vectors(routed, width)
        weights = [share.weights[bits] for share in shares]
        done = []
        columns = [runs.column(name).to_pylist() for name in ("kind", "target", "parts", "mask", "slots", "c", "p")]
        each = list(zip(*columns))
        for first in range(0, len(each), _BATCH):
            batch = each[first : first + _BATCH]
            matrices = [np.empty((len(batch), share.size, share.size)) for share in shares]
            pulls = [np.empty((len(batch), share.size)) for share in shares]
            for k, (_, _, _, _, slots, c, p) in enumerate(batch):
                slots, c, p = routing.run_arrays(slots, c, p)
                own = rows[slots]
                for share, weight, a, b in zip(shares, weights, matrices, pulls):
                    mine, w = own[:, share.start : share.stop], weight[slots]
                    a[k] = (mine.T * (w * (c - 1.0))) @ mine
                    b[k] = (w * c * p) @ mine
            whole = np.array([x[2] == 1 for x in batch])
            done.append(_batch(batch, whole, matrices, pulls, shares))
        return pa.concat_tables(done) if done else _EMPTY

    solved = parts.each(lambda own: own.routed(vectors), run, _SOLVED, width)
    if not parts.split_targets:
        return solved.select("kind", "target", "features")
    solved = cut_lineage(solved)

    def add_up(table: pa.Table, last: bool) -> pa.Table:
        a = routing.matrix(table.column("a"), sum(share.size**2 for share in shares)).sum(axis=0)
        b = routing.matrix(table.column("b"), width).sum(axis=0)
        mask = int(np.bitwise_or.reduce(table.column("mask").to_numpy()))
        matrices, at = [], 0
        for share in shares:
            matrices.append(a[at : at + share.size**2].reshape(1, share.size, share.size))
            at += share.size**2
        pulls = [b[None, share.start : share.stop] for share in shares]
        row = (table.column("kind")[0].as_py(), table.column("target")[0].as_py(), 1, mask)
        return _batch([row], np.array([last]), matrices, pulls, shares)

    slices = solved.filter(F.col("features").isNull()).withColumn("_group", F.pmod(F.xxhash64("a"), F.lit(_MERGE_GROUPS)))
    merged = slices.groupBy("kind", "target", "_group").applyInArrow(lambda table: add_up(table, False), _SOLVED)
    merged = merged.groupBy("kind", "target").applyInArrow(lambda table: add_up(table, True), _SOLVED)
    return solved.filter(F.col("features").isNotNull()).unionByName(merged).select("kind", "target", "features")


_EMPTY = pa.schema(
    [("kind", pa.int32()), ("target", pa.int64()), ("mask", pa.int32())] + [(name, pa.list_(pa.float64())) for name in ("features", "a", "b")]
).empty_table()


def _batch(batch: list[tuple], whole: np.ndarray, matrices: list[np.ndarray], pulls: list[np.ndarray], shares: list[Share]) -> pa.Table:
    """Rows of a batch of targets: solved where ``whole``, else the sums ``a`` and ``b`` to be merged."""
    keys = [np.array([x[k] for x in batch]) for k in (0, 1, 3)]
    at = np.flatnonzero(whole)
    features = np.zeros((len(at), sum(share.size for share in shares)))
    for share, a, b in zip(shares, matrices, pulls):
        if len(at):
            full = a[at] + np.stack([share.shared(int(keys[0][k]), int(keys[2][k])) for k in at])
            features[:, share.start : share.stop] = np.linalg.solve(full, b[at][:, :, None])[:, :, 0]
    rest = np.flatnonzero(~whole)
    sums = np.concatenate([a.reshape(len(a), -1)[rest] for a in matrices], axis=1)
    right = np.concatenate([b[rest] for b in pulls], axis=1)
    order = np.concatenate([at, rest])
    none = lambda n: pa.nulls(n, pa.list_(pa.float64()))
    return pa.table(
        {
            "kind": pa.array(keys[0][order], pa.int32()),
            "target": pa.array(keys[1][order], pa.int64()),
            "mask": pa.array(keys[2][order], pa.int32()),
            "features": pa.concat_arrays([routing.lists(features), none(len(rest))]),
            "a": pa.concat_arrays([none(len(at)), routing.lists(sums)]),
            "b": pa.concat_arrays([none(len(at)), routing.lists(right)]),
        }
    )


def _side_number() -> Column:
    return F.array_position(F.array(*[F.lit(side) for side in SIDES]), F.col("side")).cast("int") - 1


def _side_name(kind: str = "kind") -> Column:
    return F.element_at(F.array(*[F.lit(side) for side in SIDES]), F.col(kind) + 1)


def _slices(configs: list[CMFConfig]) -> list[tuple[int, int]]:
    ends = np.cumsum([config.factors for config in configs]).tolist()
    return [(end - config.factors, end) for end, config in zip(ends, configs)]


def update_all_sides(parts: Parts, users: DataFrame, configs: list[CMFConfig]) -> DataFrame:
    """All feature factors of all models from fixed user factors: ``side, id, features``; one pass for all four sides."""
    spans = _slices(configs)
    fixed = gramians(users.select(F.lit("user").alias("side"), "features"), spans[-1][1])["user"]
    shares = []
    for config, (start, stop) in zip(configs, spans):
        ridge = np.eye(config.factors) * config.regularization
        base = {number: fixed[start:stop, start:stop] + ridge * config.weights()[side] for number, side in enumerate(SIDES)}
        shares.append(Share(start, stop, np.ones(len(SIDES)), base, False))
    other = users.select(F.lit(0).alias("bit"), F.col("id").alias("other"), "features")
    return solve(parts, other, shares).select(_side_name().alias("side"), F.col("target").alias("id"), "features")


def update_all_users(parts: Parts, sides: DataFrame, configs: list[CMFConfig]) -> DataFrame:
    """User factors of all models from all fixed sides: ``id, features``."""
    spans = _slices(configs)
    fixed = gramians(sides, spans[-1][1])
    shares = []
    for config, (start, stop) in zip(configs, spans):
        weights = np.array([config.weights()[side] for side in SIDES])
        none = np.zeros((spans[-1][1], spans[-1][1]))
        base = {number: weights[number] * fixed.get(side, none)[start:stop, start:stop] for number, side in enumerate(SIDES)}
        base[-1] = np.eye(config.factors) * config.regularization
        shares.append(Share(start, stop, weights, base, True))
    other = sides.select(_side_number().alias("bit"), F.col("id").alias("other"), "features")
    return solve(parts, other, shares).select(F.col("target").alias("id"), "features")


def update_sides(parts: Parts, users: DataFrame, config: CMFConfig) -> DataFrame:
    """The half-step of one model that updates the features."""
    return update_all_sides(parts, users, [config])


def update_users(parts: Parts, sides: DataFrame, config: CMFConfig) -> DataFrame:
    """The half-step of one model that updates the users."""
    return update_all_users(parts, sides, [config])


def loss_over(parts: Parts, users: DataFrame, sides: DataFrame, config: CMFConfig) -> DataFrame:
    """The loss from entries laid out by user: side factors and the users' own are sent once per part."""
    width = config.factors
    weights = np.array([config.weights()[side] for side in SIDES])
    others = sides.select(_side_number().alias("bit"), F.col("id").alias("other"), "features")

    def send(own: Parts) -> DataFrame:
        owners = own.runs.select("part", F.col("target").alias("id")).distinct().join(users, "id")
        # slots below zero are the part's own users
        return own.routed(others).select("part", "slot", "bit", F.lit(None).cast("long").alias("id"), "features").unionByName(
            owners.select("part", F.lit(-1).alias("slot"), F.lit(0).alias("bit"), "id", "features")
        )

    def run(runs: pa.Table, routed: pa.Table) -> pa.Table:
        slot = routed.column("slot").to_numpy()
        own = routed.filter(pa.array(slot < 0))
        vectors = dict(zip(own.column("id").to_pylist(), routing.matrix(own.column("features"), width)))
        rows, bits = routing.listed_vectors(routed.filter(pa.array(slot >= 0)), width)
        total = 0.0
        for target, slots, c, p in zip(*[runs.column(name).to_pylist() for name in ("target", "slots", "c", "p")]):
            slots, c, p = routing.run_arrays(slots, c, p)
            if target in vectors and slots.max() < len(rows):
                error = p - rows[slots] @ vectors[target]
                total += float((weights[bits[slots]] * c) @ (error * error))
        return pa.table({"x": [total]})

    errors = parts.each(send, run, "x double", width)
    wide = F.col("features").cast("array<double>")
    both = users.select("features").unionByName(sides.select("features"))
    ridge = both.select((vec.dot(wide, wide) * config.regularization).alias("x"))
    return errors.unionByName(ridge).agg(F.sum("x").alias("loss"))


def loss(entries: DataFrame, users: DataFrame, sides: DataFrame, config: CMFConfig) -> DataFrame:
    """Weighted squared error over the observed entries plus the ridge term, one row."""
    return loss_over(lay_out(entries, True), users, sides, config)


def fit_many(
    entries: DataFrame,
    configs: list[CMFConfig],
    users: DataFrame | None = None,
    how: str | None = None,
    report_loss: bool = False,
    start: DataFrame | None = None,
) -> list[Factors]:
    """Fit several models; those with the same confidence and number of iterations share every pass over the entries."""
    fitted: dict[int, Factors] = {}
    groups: dict[tuple, list[int]] = {}
    for at, config in enumerate(configs):
        shape = how or ("shifted" if config.use_confidence else "raw")
        groups.setdefault((config.alpha, shape, config.iterations), []).append(at)
    for (alpha, shape, iterations), members in groups.items():
        own = [configs[at] for at in members]
        rows, path = stored(entries)
        weighted = with_confidence(rows, alpha, shape)
        ids = (weighted.select(F.col("u").alias("id")) if users is None else users.select("id")).distinct()
        # a part's vectors stay under some 128 MB
        room = max(1_000, min(PART_ENTRIES, (128 << 20) // (4 * sum(config.factors for config in own))))
        by_side, by_user = lay_out(weighted, False, room), lay_out(weighted, True, room)
        if start is None:
            first = init_factors(ids, "user", own[0].factors, own[0].random_state)
            for at, config in enumerate(own[1:], 1):
                more = init_factors(ids, "user", config.factors, config.random_state).withColumnRenamed("features", f"_{at}")
                first = first.join(more, "id")
            first = first.select("id", F.concat("features", *[f"_{at}" for at in range(1, len(own))]).alias("features"))
        else:
            first = start.join(ids, "id", "left_semi")
        current = cut_lineage(first.select("id", "features"))
        discard(entries.sparkSession, path)
        single = F.col("features").cast("array<float>").alias("features")
        sides, losses = None, [[] for _ in own]
        cuts = lambda frame, span: frame.withColumn("features", F.slice("features", span[0] + 1, span[1] - span[0]))
        for _ in range(iterations):
            before = [current] if sides is None else [current, sides]
            sides = cut_lineage(update_all_sides(by_side, current, own).select("side", "id", single))
            current = cut_lineage(update_all_users(by_user, sides, own).select("id", single))
            for frame in before:
                forget(frame)
            if report_loss:
                for config, span, seen in zip(own, _slices(own), losses):
                    with shuffles_dropped(entries.sparkSession):
                        seen.append(loss_over(by_user, cuts(current, span), cuts(sides, span), config).first()[0])
        by_side.discard()
        by_user.discard()
        for at, config, span, seen in zip(members, own, _slices(own), losses):
            one = len(own) == 1
            fitted[at] = Factors(current if one else cuts(current, span), sides if one else cuts(sides, span), config.factors, seen)
    return [fitted[at] for at in range(len(configs))]


def fit(
    entries: DataFrame,
    config: CMFConfig = CMFConfig(),
    users: DataFrame | None = None,
    how: str | None = None,
    report_loss: bool = False,
    start: DataFrame | None = None,
) -> Factors:
    """Alternate side and user updates from hash-seeded user factors, or from ``start`` (``id, features``).

    ``entries`` has ``side, u, feature, r``. ``users(id)`` may name users beyond those with entries: they
    take part in the first Gramian like everyone else and end up at zero.
    """
    return fit_many(entries, [config], users, how, report_loss, start)[0]


def fit_implicit_als(
    ratings: DataFrame, factors: int = 192, reg: float = 0.05, alpha: float = 160.0, iterations: int = 30, seed: int = 42
) -> Factors:
    """Plain implicit-feedback factorisation of the user-item matrix with ``alpha r`` as confidence."""
    config = CMFConfig(
        factors=factors, iterations=iterations, regularization=reg, alpha=alpha, random_state=seed
    )
    return fit(stack_entries({"item": ratings}), config, how="scaled")


def side_factors(sides: DataFrame, side: str) -> DataFrame:
    return sides.filter(F.col("side") == side).select("id", F.col("features").cast("array<double>").alias("features"))


def item_vectors(
    items: DataFrame,
    sides: DataFrame,
    size: int,
    item_subjects: DataFrame | None = None,
    weights: ScoreWeights = ScoreWeights(),
) -> DataFrame:
    """One vector per item whose dot product with a user's factor is the whole prediction.

    The prediction is linear in the user factor, so item, author, publisher and the weighted mean of the
    subject factors fold into ``i, features``. ``items`` has ``i`` and, if wanted, the two codes.
    """
    none = vec.zeros(size)

    def look_up(frame: DataFrame, side: str, key: str, name: str) -> DataFrame:
        table = side_factors(sides, side).select(F.col("id").alias(key), F.col("features").alias(name))
        return frame.join(table, key, "left").withColumn(name, F.coalesce(name, none))

    joined = look_up(items, "item", "i", "_item")
    total = vec.scale(F.col("_item"), weights.item)
    if "author_code" in items.columns:
        joined = look_up(joined, "author", "author_code", "_author")
        total = vec.add(total, vec.scale(F.col("_author"), weights.author))
    if "publisher_code" in items.columns:
        joined = look_up(joined, "publisher", "publisher_code", "_publisher")
        total = vec.add(total, vec.scale(F.col("_publisher"), weights.publisher))
    if item_subjects is not None:
        tagged = look_up(item_subjects, "subject", "subject_idx", "_subject")
        mean = tagged.groupBy("i").agg(
            vec.vector_sum(F.col("_subject"), F.col("weight")).alias("_sum"), F.sum("weight").alias("_weight")
        )
        mean = mean.select("i", vec.scale(F.col("_sum"), 1 / (F.col("_weight") + vec.EPSILON)).alias("_subjects"))
        joined = joined.join(mean, "i", "left")
        total = vec.add(total, vec.scale(F.coalesce("_subjects", none), weights.subject))
    return joined.select("i", total.alias("features"))


def user_vectors(users: DataFrame, factors: DataFrame, size: int) -> DataFrame:
    """A factor for each of ``users(u)``, zeros where training gave none."""
    known = factors.select(F.col("id").alias("u"), F.col("features").cast("array<double>").alias("features"))
    return users.join(known, "u", "left").withColumn("features", F.coalesce("features", vec.zeros(size)))


def predict_topk(
    users: DataFrame, items: DataFrame, k: int, skip: DataFrame | None = None, digits: int = 9
) -> DataFrame:
    """Best ``k`` items per user from ``users(u, features)`` and ``items(i, features)``."""
    found = dense_product(
        users.select(F.col("u").alias("row_id"), "features"),
        items.select(F.col("i").alias("col_id"), "features"),
        k=k,
        skip=None if skip is None else skip.select(F.col("u").alias("row_id"), F.col("i").alias("col_id")),
        digits=digits,
    )
    return found.select(F.col("row_id").alias("u"), F.col("col_id").alias("i"), "score", "rank")


def score_moments(users: DataFrame, items: DataFrame, size: int) -> tuple[float, float]:
    """Mean and deviation of all users-by-items dot products, from Gramians and mean vectors alone."""

    def summary(frame: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
        cross = gramians(frame.select(F.lit("x").alias("side"), "features"), size)["x"]
        row = frame.agg(vec.vector_mean(F.col("features")).alias("mean"), F.count(F.lit(1)).alias("n")).first()
        return cross, np.asarray(row.mean), row.n

    left, left_mean, m = summary(users)
    right, right_mean, n = summary(items)
    mean = float(left_mean @ right_mean)
    squares = float((left * right).sum()) / (m * n)
    return mean, math.sqrt(max(squares - mean * mean, 0.0))


def cosine_vectors(frame: DataFrame, key: str) -> DataFrame:
    """Embeddings scaled to unit length as ``key, features``."""
    return frame.select(key, vec.unit(F.col("embedding")).alias("features"))


def cosine_sides(user_embeddings: DataFrame, item_embeddings: DataFrame, dim: int) -> tuple[DataFrame, DataFrame, tuple[float, float]]:
    """Unit vectors of users and items, written once, and mean and deviation of all their dot products."""
    user_side = cut_lineage(cosine_vectors(user_embeddings, "u"))
    item_side = cut_lineage(cosine_vectors(item_embeddings, "i"))
    return user_side, item_side, score_moments(user_side, item_side, dim)


def blended_vectors(
    users: DataFrame,
    items: DataFrame,
    size: int,
    user_embeddings: DataFrame | None,
    item_embeddings: DataFrame | None,
    dim: int,
    weight: float,
    cosines: tuple[DataFrame, DataFrame, tuple[float, float]] | None = None,
) -> tuple[DataFrame, DataFrame, float]:
    """User and item vectors whose dot product, minus the returned shift, is ``z(cmf) + weight z(cosine)``.

    ``cosines`` is what :func:`cosine_sides` makes of the embeddings, if several blends share it.
    """
    user_side, item_side, (cos_mean, cos_spread) = cosines or cosine_sides(user_embeddings, item_embeddings, dim)
    mean, spread = score_moments(users, items, size)
    spread, cos_spread = spread + vec.EPSILON, cos_spread + vec.EPSILON

    def join(left: DataFrame, right: DataFrame, key: str, scale_left: float, scale_right: float) -> DataFrame:
        other = right.select(key, F.col("features").alias("_e"))
        return left.join(other, key, "left").select(
            key,
            F.concat(
                vec.scale(F.col("features"), scale_left),
                vec.scale(F.coalesce("_e", vec.zeros(dim)), scale_right),
            ).alias("features"),
        )

    left = join(users, user_side, "u", 1.0 / spread, weight / cos_spread)
    right = join(items, item_side, "i", 1.0, 1.0)
    return left, right, mean / spread + weight * cos_mean / cos_spread
