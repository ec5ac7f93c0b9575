"""Embedding scores and the collective factorisation, from fixed and from fitted factors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog, histories, matrices
from ..operators import factorisation as cmf
from ..operators import indexing
from ..operators.ranking import submission
from ..plans import features as ft
from ..plans import training, tuning
from ..session import cut_lineage, stored
from ..sources import testbed as bed
from . import query
from .encoding import DIM, coded_items, weighted_subjects
from .fragments import statement
from .neighbours import topk

CONFIG = cmf.CMFConfig(factors=8, iterations=2, alpha=40.0)
# The least settings that the task names for real runs.
FULL = cmf.CMFConfig(factors=64, iterations=10, alpha=40.0)
TWO = cmf.CMFConfig(factors=2, iterations=1, alpha=40.0)

# The same fixed two-dimensional factors on both sides of the comparison.
_OFFSETS = {"user": 11, "item": 23, "author": 37, "publisher": 53, "subject": 71}


def fixed_factors(ids, label: str):
    """``id, features`` by a formula of the id, so that SQL can state them too."""
    offset = _OFFSETS[label]

    def part(step: int):
        return (F.pmod(F.col("id") * step + offset, F.lit(97)) + 1) / 100.0 - 0.4

    return ids.select("id", F.array(part(31), part(57)).alias("features"))


def _fixed_sql(label: str, key: str) -> str:
    offset = _OFFSETS[label]
    return f"(({key} * 31 + {offset}) % 97 + 1) / 100.0 - 0.4 AS x, (({key} * 57 + {offset}) % 97 + 1) / 100.0 - 0.4 AS y"


_MATRICES = "loans items clean authors publishers coded tags vocab tf weights ratings"
_MODEL = {
    "entries": """
        SELECT 'item' AS side, u, i AS feature, r FROM ratings
        UNION ALL SELECT 'author', u, author_code, CAST(count(*) AS DOUBLE) FROM loans JOIN coded USING (i) GROUP BY ALL
        UNION ALL SELECT 'publisher', u, publisher_code, CAST(count(*) AS DOUBLE) FROM loans JOIN coded USING (i)
                  GROUP BY ALL
        UNION ALL SELECT 'subject', u, subject_idx, sum(weight) FROM loans JOIN weights USING (i) GROUP BY ALL""",
    "lam": "SELECT * FROM (VALUES ('item', 1.0::DOUBLE), ('author', 0.3), ('publisher', 0.2), ('subject', 0.2)) AS l(side, w)",
    "uf": f"SELECT u, {_fixed_sql('user', 'u')} FROM (SELECT DISTINCT u FROM loans)",
    "sf": " UNION ALL ".join(
        f"SELECT '{side}' AS side, feature, {_fixed_sql(side, 'feature')} FROM (SELECT DISTINCT feature FROM entries WHERE side = '{side}')"
        for side in cmf.SIDES
    ),
}
_NAMES = _MATRICES + " entries lam uf sf"


def entries_of(spark, folder):
    loans = matrices.counted(stored(bed.loans(spark, folder))[0])
    cleaned = cut_lineage(catalog.clean_items(bed.items(spark, folder), loans))
    coded = cut_lineage(coded_items(spark, folder, cleaned)[0])
    weights = cut_lineage(weighted_subjects(spark, folder, cleaned))
    stacked = cmf.stack_entries(
        {
            "item": matrices.user_item_counts(loans),
            "author": matrices.user_author_matrix(loans, coded),
            "publisher": matrices.user_publisher_matrix(loans, coded),
            "subject": matrices.user_subject_matrix(loans, weights),
        }
    )
    return stored(stacked)[0], coded, weights


def fixed_model(entries):
    users = fixed_factors(entries.select(F.col("u").alias("id")).distinct(), "user")
    features, sides = cut_lineage(entries.select("side", F.col("feature").alias("id")).distinct()), None
    for side in cmf.SIDES:
        ids = features.filter(F.col("side") == side).select("id")
        rows = fixed_factors(ids, side).select(F.lit(side).alias("side"), "id", "features")
        sides = rows if sides is None else sides.unionByName(rows)
    return cut_lineage(users), cut_lineage(sides)


def _two(frame, *keys):
    parts = [F.round(F.col("features")[at], 6).alias(name) for at, name in enumerate(("x", "y"))]
    return frame.select(*keys, *parts)


_CRAMER = """round((a22 * b1 - a12 * b2) / (a11 * a22 - a12 * a12), 6) AS x,
             round((a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12), 6) AS y"""


@query(
    "cmf_side_half_step",
    statement(
        _NAMES + " g sums",
        f"""SELECT side, id, {_CRAMER} FROM (
                SELECT side, id, gxx + sxx + 0.05 * w AS a11, gxy + sxy AS a12, gyy + syy + 0.05 * w AS a22, b1, b2
                FROM sums JOIN lam USING (side), g)""",
        {
            **_MODEL,
            "g": "SELECT sum(x * x) AS gxx, sum(x * y) AS gxy, sum(y * y) AS gyy FROM uf",
            "sums": """SELECT side, feature AS id, sum(40 * r * x * x) AS sxx, sum(40 * r * x * y) AS sxy,
                              sum(40 * r * y * y) AS syy, sum((1 + 40 * r) * x) AS b1, sum((1 + 40 * r) * y) AS b2
                       FROM entries JOIN uf USING (u) GROUP BY side, feature""",
        },
    ),
)
def cmf_side_half_step(spark, folder):
    entries, _, _ = entries_of(spark, folder)
    users, _ = fixed_model(entries)
    step = cmf.lay_out(cmf.with_confidence(entries, TWO.alpha), False)
    return _two(cmf.update_sides(step, users, TWO), "side", "id")


@query(
    "cmf_user_half_step",
    statement(
        _NAMES + " g sums",
        f"""SELECT id, {_CRAMER} FROM (
                SELECT u AS id, 0.05 + sum(w * (gxx + sxx)) AS a11, sum(w * (gxy + sxy)) AS a12,
                       0.05 + sum(w * (gyy + syy)) AS a22, sum(w * c1) AS b1, sum(w * c2) AS b2
                FROM sums JOIN lam USING (side) JOIN g USING (side) GROUP BY u)""",
        {
            **_MODEL,
            "g": "SELECT side, sum(x * x) AS gxx, sum(x * y) AS gxy, sum(y * y) AS gyy FROM sf GROUP BY side",
            "sums": """SELECT side, u, sum(40 * r * x * x) AS sxx, sum(40 * r * x * y) AS sxy, sum(40 * r * y * y) AS syy,
                              sum((1 + 40 * r) * x) AS c1, sum((1 + 40 * r) * y) AS c2
                       FROM entries JOIN sf USING (side, feature) GROUP BY side, u""",
        },
    ),
)
def cmf_user_half_step(spark, folder):
    entries, _, _ = entries_of(spark, folder)
    _, sides = fixed_model(entries)
    step = cmf.lay_out(cmf.with_confidence(entries, TWO.alpha), True)
    return _two(cmf.update_users(step, sides, TWO), "id")


@query(
    "cmf_loss",
    statement(
        _NAMES,
        """SELECT round((SELECT sum(w * (1 + 40 * r) * pow(1 - (uf.x * sf.x + uf.y * sf.y), 2))
                         FROM entries JOIN lam USING (side) JOIN uf USING (u) JOIN sf USING (side, feature))
                        + 0.05 * ((SELECT sum(x * x + y * y) FROM uf) + (SELECT sum(x * x + y * y) FROM sf)), 3) AS loss""",
        _MODEL,
    ),
)
def cmf_loss(spark, folder):
    entries, _, _ = entries_of(spark, folder)
    users, sides = fixed_model(entries)
    value = cmf.loss(cmf.with_confidence(entries, TWO.alpha), users, sides, TWO)
    return value.withColumn("loss", F.round("loss", 3))


@query(
    "factor_gramian",
    statement(
        _NAMES,
        """SELECT side, round(sum(x * x), 6) AS xx, round(sum(x * y), 6) AS xy, round(sum(y * y), 6) AS yy
           FROM sf GROUP BY side""",
        _MODEL,
    ),
)
def factor_gramian(spark, folder):
    entries, _, _ = entries_of(spark, folder)
    _, sides = fixed_model(entries)
    rows = [
        (side, round(float(g[0, 0]), 6), round(float(g[0, 1]), 6), round(float(g[1, 1]), 6))
        for side, g in cmf.gramians(sides, 2).items()
    ]
    return spark.createDataFrame(rows, "side string, xx double, xy double, yy double")


_VECTORS = {
    **_MODEL,
    "subject_mean": """
        SELECT i, sum(weight * coalesce(x, 0)) / (sum(weight) + 1e-8) AS x,
               sum(weight * coalesce(y, 0)) / (sum(weight) + 1e-8) AS y
        FROM weights LEFT JOIN sf ON sf.side = 'subject' AND sf.feature = subject_idx GROUP BY i""",
    "iv": """
        SELECT c.i, coalesce(v.x, 0) + 0.3 * coalesce(a.x, 0) + 0.2 * coalesce(p.x, 0) + 0.2 * coalesce(s.x, 0) AS x,
               coalesce(v.y, 0) + 0.3 * coalesce(a.y, 0) + 0.2 * coalesce(p.y, 0) + 0.2 * coalesce(s.y, 0) AS y
        FROM coded c LEFT JOIN sf v ON v.side = 'item' AND v.feature = c.i
        LEFT JOIN sf a ON a.side = 'author' AND a.feature = c.author_code
        LEFT JOIN sf p ON p.side = 'publisher' AND p.feature = c.publisher_code
        LEFT JOIN subject_mean s ON s.i = c.i""",
    "scores": "SELECT u, i, uf.x * iv.x + uf.y * iv.y AS score FROM uf CROSS JOIN iv",
}


def fixed_vectors(spark, folder):
    entries, coded, weights = entries_of(spark, folder)
    users, sides = fixed_model(entries)
    items = cmf.item_vectors(coded.select("i", "author_code", "publisher_code"), sides, 2, weights)
    return users.select(F.col("id").alias("u"), "features"), cut_lineage(items)


def _shown(frame):
    return frame.select("u", "i", F.round("score", 6).alias("score"), "rank")


@query("cmf_predict_topk", statement(_NAMES + " subject_mean iv scores", topk("scores"), _VECTORS))
def cmf_predict_topk(spark, folder):
    return _shown(cmf.predict_topk(*fixed_vectors(spark, folder), 10))


@query(
    "cmf_unseen_topk",
    statement(
        _NAMES + " subject_mean iv scores unseen",
        topk("unseen"),
        {**_VECTORS, "unseen": "SELECT * FROM scores ANTI JOIN ratings USING (u, i)"},
    ),
)
def cmf_unseen_topk(spark, folder):
    seen = bed.loans(spark, folder).select("u", "i").distinct()
    return _shown(cmf.predict_topk(*fixed_vectors(spark, folder), 10, skip=seen))


@query(
    "score_moments_global",
    statement(
        _NAMES + " subject_mean iv scores",
        "SELECT round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS deviation FROM scores",
        _VECTORS,
    ),
)
def score_moments_global(spark, folder):
    mean, deviation = cmf.score_moments(*fixed_vectors(spark, folder), 2)
    return spark.createDataFrame([(round(mean, 6), round(deviation, 6))], "mean double, deviation double")


_EMBEDDED = " emb emb_long profile_long profiles emb_unit profile_unit"


@query(
    "embedding_scores_topk",
    statement(
        "loans ratings" + _EMBEDDED + " cosines",
        topk("cosines"),
        {
            "cosines": """SELECT u, i, list_dot_product(p.e, x.e) AS score FROM profile_unit p CROSS JOIN emb_unit x"""
        },
    ),
)
def embedding_scores_topk(spark, folder):
    return _shown(training.embedding_topk(bed.loans(spark, folder), bed.item_embeddings(spark, folder), DIM))


@query(
    "embedding_dot_topk",
    statement(
        "loans ratings emb emb_long profile_long profiles dots",
        topk("dots"),
        {"dots": "SELECT u, i, list_dot_product(p.e, x.e) AS score FROM profiles p CROSS JOIN emb x"},
    ),
)
def embedding_dot_topk(spark, folder):
    found = training.embedding_topk(
        bed.loans(spark, folder), bed.item_embeddings(spark, folder), DIM, normalize=False
    )
    return _shown(found)


_BLEND = {
    **_VECTORS,
    "cosines": """
        SELECT p.u, c.i, coalesce(list_dot_product(p.e, x.e), 0) AS cosine
        FROM profile_unit p CROSS JOIN coded c LEFT JOIN emb_unit x ON x.i = c.i""",
    "both_scores": "SELECT * FROM scores JOIN cosines USING (u, i)",
    "moments": """
        SELECT avg(score) AS m1, stddev_pop(score) + 1e-8 AS s1, avg(cosine) AS m2, stddev_pop(cosine) + 1e-8 AS s2
        FROM both_scores""",
    "blended": "SELECT u, i, (score - m1) / s1 + 0.15 * (cosine - m2) / s2 AS score FROM both_scores, moments",
}


@query(
    "cmf_embedding_blend",
    statement(
        _NAMES + " subject_mean iv scores" + _EMBEDDED + " cosines both_scores moments blended",
        topk("blended"),
        _BLEND,
    ),
)
def cmf_embedding_blend(spark, folder):
    users, items = fixed_vectors(spark, folder)
    embeddings = indexing.reindex_embeddings(items.select("i"), bed.item_embeddings(spark, folder), DIM)
    profiles = matrices.user_embeddings(bed.loans(spark, folder), embeddings, DIM)
    left, right, shift = cmf.blended_vectors(users, items, 2, profiles, embeddings, DIM, 0.15)
    ranked = cmf.predict_topk(left, right, 10)
    return _shown(ranked.withColumn("score", F.col("score") - shift))


def _split_model(spark, folder):
    loans = bed.loans(spark, folder)
    labelled = stored(histories.temporal_split(loans))[0]
    catalogue = ft.build_catalogue(bed.items(spark, folder), labelled)
    return labelled, catalogue, ft.all_users(labelled)


def _solved(a11, a12, a22):
    """Cramer's rule with the result stored as a single, as the fit stores it."""
    det = f"({a11} * {a22} - {a12} * {a12})"
    return (f"CAST(CAST(({a22} * b1 - {a12} * b2) / {det} AS FLOAT) AS DOUBLE) AS x, "
            f"CAST(CAST(({a11} * b2 - {a12} * b1) / {det} AS FLOAT) AS DOUBLE) AS y")


def _fit_parts(alpha: int, ridge: float) -> dict[str, str]:
    """One iteration of the fit in SQL, two factors: all sides from ``uf``, then all users from those sides."""
    return {
        **_MODEL,
        "g1": "SELECT sum(x * x) AS gxx, sum(x * y) AS gxy, sum(y * y) AS gyy FROM uf",
        "sums1": f"""SELECT side, feature, sum({alpha} * r * x * x) AS sxx, sum({alpha} * r * x * y) AS sxy,
                            sum({alpha} * r * y * y) AS syy, sum((1 + {alpha} * r) * x) AS b1, sum((1 + {alpha} * r) * y) AS b2
                     FROM entries JOIN uf USING (u) GROUP BY side, feature""",
        "sf1": f"""SELECT side, feature, {_solved('a11', 'a12', 'a22')} FROM (
                       SELECT side, feature, gxx + sxx + {ridge} * w AS a11, gxy + sxy AS a12, gyy + syy + {ridge} * w AS a22, b1, b2
                       FROM sums1 JOIN lam USING (side), g1)""",
        "g2": "SELECT side, sum(x * x) AS gxx, sum(x * y) AS gxy, sum(y * y) AS gyy FROM sf1 GROUP BY side",
        "sums2": f"""SELECT side, u, sum({alpha} * r * x * x) AS sxx, sum({alpha} * r * x * y) AS sxy,
                            sum({alpha} * r * y * y) AS syy, sum((1 + {alpha} * r) * x) AS c1, sum((1 + {alpha} * r) * y) AS c2
                     FROM entries JOIN sf1 USING (side, feature) GROUP BY side, u""",
        "uf1": f"""SELECT u, {_solved('a11', 'a12', 'a22')} FROM (
                       SELECT u, {ridge} + sum(w * (gxx + sxx)) AS a11, sum(w * (gxy + sxy)) AS a12,
                              {ridge} + sum(w * (gyy + syy)) AS a22, sum(w * c1) AS b1, sum(w * c2) AS b2
                       FROM sums2 JOIN lam USING (side) JOIN g2 USING (side) GROUP BY u)""",
    }


@query(
    "cmf_fit_factors",
    statement(
        _NAMES + " g1 sums1 sf1 g2 sums2 uf1",
        """SELECT 'user' AS side, u AS id, round(x, 5) AS x, round(y, 5) AS y FROM uf1
           UNION ALL SELECT side, feature, round(x, 5), round(y, 5) FROM sf1""",
        _fit_parts(40, 0.05),
    ),
)
def cmf_fit_factors(spark, folder):
    entries, _, _ = entries_of(spark, folder)
    users, _ = fixed_model(entries)
    fitted = cmf.fit(entries, TWO, start=users)
    rows = fitted.users.select(F.lit("user").alias("side"), "id", "features").unionByName(fitted.sides.select("side", "id", "features"))
    part = lambda at: F.round(F.col("features")[at].cast("double"), 5)
    return rows.select("side", "id", part(0).alias("x"), part(1).alias("y"))


@query("cmf_fit_recommend")
def cmf_fit_recommend(spark, folder):
    labelled, catalogue, users = _split_model(spark, folder)
    model = training.train(histories.select_split(labelled, "train"), catalogue, CONFIG, users=users)
    return _shown(training.rank(model, 10))


@query("cmf_train_losses")
def cmf_train_losses(spark, folder):
    loans = stored(bed.loans(spark, folder))[0]
    catalogue = ft.build_catalogue(bed.items(spark, folder), loans)
    fitted = cmf.fit(ft.model_entries(loans, catalogue), CONFIG, report_loss=True)
    rows = [(at + 1, round(value, 3)) for at, value in enumerate(fitted.losses)]
    return spark.createDataFrame(rows, "iteration int, loss double")


@query("full_training_submission")
def full_training_submission(spark, folder):
    lines, _ = training.train_and_submit(
        stored(bed.loans(spark, folder))[0],
        bed.items(spark, folder),
        FULL,
        bed.item_embeddings(spark, folder),
        DIM,
    )
    return lines


@query("als_recommend")
def als_recommend(spark, folder):
    ratings = cut_lineage(matrices.user_item_counts(bed.loans(spark, folder)))
    fitted = cmf.fit_implicit_als(ratings, factors=8, iterations=2)
    users = fitted.users.select(F.col("id").alias("u"), "features")
    items = cmf.side_factors(fitted.sides, "item").select(F.col("id").alias("i"), "features")
    return _shown(cmf.predict_topk(users, items, 10))


@query("grid_search_map")
def grid_search_map(spark, folder):
    labelled, catalogue, users = _split_model(spark, folder)
    embeddings = indexing.reindex_embeddings(catalogue.items.select("i"), bed.item_embeddings(spark, folder), DIM)
    tried, best, _ = tuning.grid_search(
        histories.select_split(labelled, "train"),
        histories.select_split(labelled, "val"),
        catalogue,
        users,
        {"factors": [4, 8]},
        CONFIG,
        cut_lineage(embeddings),
        DIM,
    )
    rows = [(t["factors"], t["w_embedding"], round(t["map_at_k"], 9), t is best) for t in tried]
    return spark.createDataFrame(rows, "factors int, w_embedding double, map_at_k double, best boolean")
