"""Neighbourhood scores, popularity lists, hybrid lists and their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog, encoders, evaluation, histories, matrices, ranking
from ..operators import neighbours as nb
from ..plans import hybrid
from ..plans.tuning import weight_grid
from ..session import cut_lineage
from ..sources import testbed as bed
from . import query
from .encoding import cleaned_items
from .fragments import statement


def ratings_of(spark, folder):
    return cut_lineage(matrices.user_item_counts(bed.loans(spark, folder)))


def _shown(frame, *keys):
    return frame.select(*keys, F.round("score", 6).alias("score"), "rank")


def topk(source: str, k: int = 10, score: str = "round(score, 9)") -> str:
    return f"""SELECT u, i, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM (
                   SELECT u, i, score, row_number() OVER (PARTITION BY u ORDER BY {score} DESC, i) AS rank FROM {source})
               WHERE rank <= {k}"""


@query(
    "item_item_neighbors",
    statement(
        "loans ratings inorm alike neighbours",
        "SELECT i, neighbour, round(similarity, 6) AS similarity, CAST(rank AS INT) AS rank FROM neighbours",
    ),
)
def item_item_neighbors(spark, folder):
    kept = nb.item_neighbours(ratings_of(spark, folder), 100)
    return kept.withColumn("similarity", F.round("similarity", 6))


@query(
    "item_item_cf_topk",
    statement("loans ratings inorm alike neighbours item_item", topk("item_item")),
)
def item_item_cf_topk(spark, folder):
    return _shown(nb.item_item_topk(ratings_of(spark, folder), 10), "u", "i")


@query("user_user_cf_topk", statement("loans ratings unorm carried user_user", topk("user_user")))
def user_user_cf_topk(spark, folder):
    return _shown(nb.user_user_topk(ratings_of(spark, folder), 10), "u", "i")


_Z = """(score - sum(score) OVER w / {n})
        / (sqrt(greatest(sum(score * score) OVER w / {n} - pow(sum(score) OVER w / {n}, 2), 0)) + 1e-8)"""
_Z0 = """(-sum(score) OVER w / {n})
        / (sqrt(greatest(sum(score * score) OVER w / {n} - pow(sum(score) OVER w / {n}, 2), 0)) + 1e-8)"""
_N = "(SELECT count(*) FROM clean)"


@query(
    "subject_overlap_z",
    statement(
        "loans items clean tags ratings overlap zs",
        """SELECT u, i, score, CAST(rank AS INT) AS rank, z, z_missing FROM (
               SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, i) AS rank FROM zs) WHERE rank <= 200""",
        {
            "zs": f"""SELECT u, i, score, round({_Z.format(n=_N)}, 6) AS z, round({_Z0.format(n=_N)}, 6) AS z_missing
                      FROM overlap WINDOW w AS (PARTITION BY u)"""
        },
    ),
)
def subject_overlap_z(spark, folder):
    cleaned = cut_lineage(cleaned_items(spark, folder))
    numbered = encoders.number_subjects(catalog.subject_rows(cleaned))
    profile = matrices.user_subject_counts(bed.loans(spark, folder), cleaned, numbered)
    inputs = nb.subject_overlap_inputs(profile, encoders.item_subject_index(cleaned, numbered))
    best, sums = ranking.Signal("subjects", *inputs).candidates(200)
    mean, spread = nb.zscore_terms(F.col("total"), F.col("squares"), cleaned.count())
    return best.join(sums, "row_id").select(
        F.col("row_id").alias("u"),
        F.col("col_id").alias("i"),
        "score",
        "rank",
        F.round((F.col("score") - mean) / spread, 6).alias("z"),
        F.round(-mean / spread, 6).alias("z_missing"),
    )


_UNSEEN = {
    "unseen": """
        SELECT u, i, rank, borrow_count FROM (
            SELECT x.u, p.i, p.borrow_count, row_number() OVER (PARTITION BY x.u ORDER BY p.place) AS rank
            FROM (SELECT DISTINCT u FROM base) x CROSS JOIN popular p
            ANTI JOIN base s ON s.u = x.u AND s.i = p.i) WHERE rank <= 10"""
}
_ALL = {"base": "SELECT * FROM loans", **_UNSEEN}
_TRAIN = {
    "base": "SELECT u, i, t FROM split WHERE split = 'train'",
    "popular": """SELECT i, borrow_count, row_number() OVER (ORDER BY borrow_count DESC, i) - 1 AS place
                  FROM (SELECT i, count(*) AS borrow_count FROM base GROUP BY i)""",
    **_UNSEEN,
}


@query(
    "popular_unseen_topk",
    statement(
        "loans popular base unseen",
        "SELECT u, i, CAST(borrow_count AS DOUBLE) AS score, CAST(rank AS INT) AS rank FROM unseen",
        _ALL,
    ),
)
def popular_unseen_topk(spark, folder):
    return ranking.popular_unseen(cut_lineage(bed.loans(spark, folder)), 10)


def popularity_on_split(spark, folder):
    """Labelled loans and the popularity lists of the training part."""
    labelled = cut_lineage(histories.temporal_split(bed.loans(spark, folder)))
    return labelled, ranking.popular_unseen(histories.select_split(labelled, "train"), 10)


_AP = {
    "relevant": "SELECT DISTINCT u, i FROM split WHERE split = 'val'",
    "hits": """SELECT h.u, rank, row_number() OVER (PARTITION BY h.u ORDER BY rank) AS seen
               FROM unseen h JOIN relevant r ON r.u = h.u AND r.i = h.i""",
    "ap": """SELECT n.u, coalesce(sum(seen / rank), 0) / least(any_value(n.n), 10) AS ap
             FROM (SELECT u, count(*) AS n FROM relevant GROUP BY u) n LEFT JOIN hits ON hits.u = n.u GROUP BY n.u""",
}


@query(
    "map_at_10_popularity",
    statement(
        "loans split base popular unseen relevant hits ap",
        "SELECT count(*) AS n_users, round(avg(ap), 9) AS map_at_k FROM ap",
        {**_TRAIN, **_AP},
    ),
)
def map_at_10_popularity(spark, folder):
    labelled, lists = popularity_on_split(spark, folder)
    result = evaluation.map_at_k(lists, histories.select_split(labelled, "val"))
    return result.withColumn("map_at_k", F.round("map_at_k", 9))


@query(
    "average_precision_popularity",
    statement(
        "loans split base popular unseen relevant hits ap", "SELECT u, round(ap, 9) AS ap FROM ap", {**_TRAIN, **_AP}
    ),
)
def average_precision_popularity(spark, folder):
    labelled, lists = popularity_on_split(spark, folder)
    scored = evaluation.average_precision(lists, histories.select_split(labelled, "val"))
    return scored.withColumn("ap", F.round("ap", 9))


@query(
    "submission_popularity",
    statement(
        "loans split base popular unseen",
        """SELECT u AS user_id, string_agg(CAST(i AS VARCHAR), ' ' ORDER BY rank) AS recommendation
           FROM unseen GROUP BY u""",
        _TRAIN,
    ),
)
def submission_popularity(spark, folder):
    return ranking.submission(popularity_on_split(spark, folder)[1])


def _signal(name: str, source: str) -> dict[str, str]:
    z, z0 = _Z.format(n=_N), _Z0.format(n=_N)
    return {
        f"{name}_z": f"SELECT u, i, score, {z} AS z, {z0} AS z0 FROM {source} WINDOW w AS (PARTITION BY u)",
        f"{name}_zero": f"SELECT u, any_value(z0) AS z0 FROM {name}_z GROUP BY u",
        f"{name}_top": f"""SELECT u, i FROM (SELECT u, i, row_number() OVER (
                               PARTITION BY u ORDER BY round(score, 9) DESC, i) AS k FROM {source}) WHERE k <= 200""",
    }


_HYBRID = {
    "ratings": "SELECT u, i, CAST(sum(interaction_rank) AS DOUBLE) AS r FROM ranked GROUP BY u, i",
    **_signal("uu", "user_user"),
    **_signal("ii", "item_item"),
    **_signal("us", "overlap"),
    "candidates": "SELECT * FROM uu_top UNION SELECT * FROM ii_top UNION SELECT * FROM us_top",
    "mixed": """
        SELECT c.u, c.i, round(0.2 * coalesce(a.z, az.z0, 0) + 0.2 * coalesce(b.z, bz.z0, 0)
                               + 0.1 * coalesce(s.z, sz.z0, 0), 9) AS score
        FROM candidates c
        LEFT JOIN uu_z a ON a.u = c.u AND a.i = c.i LEFT JOIN uu_zero az ON az.u = c.u
        LEFT JOIN ii_z b ON b.u = c.u AND b.i = c.i LEFT JOIN ii_zero bz ON bz.u = c.u
        LEFT JOIN us_z s ON s.u = c.u AND s.i = c.i LEFT JOIN us_zero sz ON sz.u = c.u""",
}


def ranked_loans(spark, folder):
    return cut_lineage(histories.clean_interactions(bed.loans(spark, folder)).drop("datetime"))


@query(
    "hybrid_rerank_topk",
    statement(
        "loans items clean tags ranked ratings unorm carried user_user inorm alike neighbours item_item overlap "
        "uu_z uu_zero uu_top ii_z ii_zero ii_top us_z us_zero us_top candidates mixed",
        topk("mixed", score="score"),
        _HYBRID,
    ),
)
def hybrid_rerank_topk(spark, folder):
    cleaned = cut_lineage(cleaned_items(spark, folder))
    features = hybrid.hybrid_table(ranked_loans(spark, folder), cleaned, cleaned.count())
    weights = ranking.HybridWeights(als=0.0)
    return _shown(hybrid.hybrid_lists(features, weights), "u", "i")


_ALS = {"factors": 8, "reg": 0.05, "alpha": 160.0, "iterations": 2}


def _hybrid_on_split(spark, folder):
    cleaned = cut_lineage(cleaned_items(spark, folder))
    labelled = cut_lineage(histories.temporal_split(ranked_loans(spark, folder)))
    training = histories.select_split(labelled, "train")
    features = hybrid.hybrid_table(training, cleaned, cleaned.count(), als=_ALS)
    return cut_lineage(features), labelled


@query("hybrid_als_topk")
def hybrid_als_topk(spark, folder):
    return _shown(hybrid.hybrid_lists(_hybrid_on_split(spark, folder)[0]), "u", "i")


@query("hybrid_weight_grid")
def hybrid_weight_grid(spark, folder):
    features, labelled = _hybrid_on_split(spark, folder)
    # every mix of fifths that sums to one and gives the factorisation at least three of them
    mixes = [
        {"als": a / 5, "user_user": b / 5, "item_item": c / 5, "subjects": (5 - a - b - c) / 5}
        for a in (3, 4, 5)
        for b in range(6 - a)
        for c in range(6 - a - b)
    ]
    scores = weight_grid(features, histories.select_split(labelled, "val"), mixes)
    return scores.withColumn("map_at_k", F.round("map_at_k", 9))


@query("hybrid_final_submission")
def hybrid_final_submission(spark, folder):
    cleaned = cut_lineage(cleaned_items(spark, folder))
    labelled = histories.temporal_split(ranked_loans(spark, folder))
    final = cut_lineage(histories.select_split(labelled, "train", "val"))
    features = hybrid.hybrid_table(final, cleaned, cleaned.count(), als=_ALS)
    return hybrid.hybrid_submission(features)
