import itertools

import numpy as np
from pyspark.sql import functions as F

from loanweave.operators import subjects as sb


def brute_average_linkage(vectors, distance):
    """Merge the closest pair of clusters by mean pairwise cosine distance until none is close enough."""
    clusters = [[n] for n in range(len(vectors))]
    similarity = vectors @ vectors.T
    while len(clusters) > 1:
        best = min(
            ((1 - similarity[np.ix_(a, b)].mean(), x, y) for (x, a), (y, b) in itertools.combinations(enumerate(clusters), 2)),
        )
        if best[0] >= distance:
            break
        clusters[best[1]] += clusters.pop(best[2])
    return {frozenset(cluster) for cluster in clusters}


def test_average_linkage_equals_pairwise_merging(spark):
    rng = np.random.default_rng(11)
    for spread in (0.25, 0.5):
        centres = rng.random((6, 10))
        points = np.abs(np.repeat(centres, 8, axis=0) + spread * rng.normal(size=(48, 10)))
        points /= np.linalg.norm(points, axis=1, keepdims=True)
        rows = [(n, m, float(points[n, m])) for n in range(48) for m in range(10)]
        found = sb.average_linkage(spark.createDataFrame(rows, "id long, mid long, value double"), 0.1).collect()
        groups = {}
        for row in found:
            groups.setdefault(row.cluster, set()).add(row.id)
        assert {frozenset(g) for g in groups.values()} == brute_average_linkage(points, 0.1)


def test_names_and_fallback(spark):
    rows = [("alpha", 3, 1), ("alphas", 3, 1), ("beta", 2, 2), ("betb", 2, 2), ("bet", 1, 2)]
    named = sb.name_clusters(spark.createDataFrame(rows, "subject string, n long, cluster long")).collect()
    assert dict(map(tuple, named)) == {"alpha": "alpha", "alphas": "alpha", "beta": "beta", "betb": "beta", "bet": "beta"}


def test_canonical_map(spark):
    texts = ["bandes dessinees"] * 3 + ["bande dessinee"] * 2 + ["guide pratique"] * 2 + ["guides pratiques"] * 4 + ["zq"] * 2
    frequencies = sb.subject_frequencies(spark.createDataFrame([(t,) for t in texts + ["rare"]], "subject string"))
    names = dict(map(tuple, sb.canonical_map(frequencies, 0.6).collect()))
    assert names == {
        "bandes dessinees": "bandes dessinees",
        "bande dessinee": "bandes dessinees",
        "guides pratiques": "guides pratiques",
        "guide pratique": "guides pratiques",
        "zq": "zq",
    }


def test_attach_by_embedding(spark):
    singles = [(0, "s0", [1.0, 0.0]), (1, "s1", [0.0, -1.0]), (2, " ", [1.0, 0.0]), (3, "s3", None), (4, "s4", [0.6, 0.8])]
    canon = [(0, "a", [2.0, 0.0]), (1, "b", [3.0, 0.0]), (2, "c", [-1.0, 1.0])]
    schema = "id long, subject string, embedding array<double>"
    found = sb.attach_by_embedding(spark.createDataFrame(singles, schema), spark.createDataFrame(canon, schema)).collect()
    assert {r.subject: r.parent for r in found} == {"s0": "a", "s1": None, "s4": "a"}


def test_rebuild(spark):
    items = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "i long, Subjects string")
    exploded = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (3, "lost")], "i long, subject string")
    names = spark.createDataFrame([("a", "A"), ("b", "A")], "subject string, canonical string")
    rows = {r.i: (r.Subjects, r.Subjects_fine) for r in sb.rebuild_subjects(items, exploded, names).collect()}
    assert rows == {1: ("A", "a; b"), 2: (None, None), 3: (None, "lost")}


def test_unified_map_prefers_frequent(spark):
    canonical = spark.createDataFrame([("a", "A")], "subject string, canonical string")
    parents = spark.createDataFrame([("a", "B", 0.9), ("b", "A", 0.7), ("c", None, None)], "subject string, parent string, similarity double")
    assert set(map(tuple, sb.unified_map(canonical, parents).collect())) == {("a", "A"), ("b", "A")}


def test_exploded_subjects_drop_empty(spark):
    items = spark.createDataFrame([(1, "Été ; 1999;; B"), (2, None)], "i long, Subjects string")
    rows = sb.exploded_subjects(items).orderBy("subject").collect()
    assert [tuple(r) for r in rows] == [(1, "b"), (1, "ete")]
    assert sb.subject_frequencies(sb.exploded_subjects(items)).filter(F.col("frequent")).count() == 0


def test_tags_are_read_by_many_tasks_and_once(spark):
    items = spark.createDataFrame([(i, f"Tag {i % 7} ; other") for i in range(70)] + [(None, "Tag 1")], "i long, Subjects string").coalesce(1)
    exploded = sb.exploded_subjects(items)
    assert exploded.rdd.getNumPartitions() >= 8
    assert exploded.count() == 141
    read = spark.sparkContext.accumulator(0)

    def note(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    singles = spark.createDataFrame([("guides",), ("guides",), ("zzz",)], "subject string").mapInArrow(note, "subject string")
    canonicals = spark.createDataFrame([("guide",), ("tapas",)], "subject string")
    found = {r.subject: r.parent for r in sb.attach_by_ngrams(singles, canonicals, 0.3).collect()}
    assert found == {"guides": "guide", "zzz": None}
    assert read.value == 3
