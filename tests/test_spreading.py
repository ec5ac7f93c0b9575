"""Tasks hold a bounded number of rows, and no long side of a join is sent whole."""

from __future__ import annotations

import datetime as dt

import pytest

from loanweave.operators import encoders, histories, indexing, matrices, spreading
from loanweave.sources import testbed as bed


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(spreading, "TASK_ROWS", 50)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_loans_are_dealt_by_rows(spark, tmp_path, small_tasks):
    day = dt.datetime(2020, 1, 1)
    spark.createDataFrame([(o, o % 7) for o in range(500)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(o, o % 11, day + dt.timedelta(days=k)) for o in range(500) for k in range(2)] + [(None, 1, day), (900, 1, day)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    loans = bed.loans(spark, str(tmp_path))
    assert loans.rdd.getNumPartitions() >= 20
    assert sorted((r.u, r.i) for r in loans.collect()) == sorted((o % 7, o % 11) for o in range(500) for _ in range(2))


def test_positions_are_numbered_in_bounded_tasks(spark, small_tasks):
    log = spark.createDataFrame([(u, i, t) for u in range(50) for i in range(4) for t in range(3)], "u long, i long, t long")
    numbered = histories.clean_interactions(log)
    assert numbered.rdd.getNumPartitions() >= 12
    assert sorted((r.u, r.i, r.t, r.interaction_rank) for r in numbered.collect()) == [
        (u, i, t, t + 1) for u in range(50) for i in range(4) for t in range(3)
    ]


def tagged(spark):
    rows = [(i, [f"tag{i % 9}", "all", f"tag{i % 5}"]) for i in range(60)]
    return spark.createDataFrame(rows, "i long, subjects_list array<string>")


def test_long_vocabulary_meets_tags_by_shuffle(spark, monkeypatch):
    cleaned = tagged(spark)
    vocabulary = encoders.number_subjects(tag_rows(cleaned))
    few = encoders.item_subject_index(cleaned, vocabulary).collect()
    monkeypatch.setattr(spreading, "LOOKUP_ROWS", 3)
    indexed = encoders.item_subject_index(cleaned, vocabulary)
    assert "SortMergeJoin" in plan_of(indexed)
    assert sorted(indexed.collect()) == sorted(few)
    assert len(few) == 180


def tag_rows(cleaned):
    return cleaned.selectExpr("explode(subjects_list) AS subject")


def test_matched_ids_are_not_sent_whole(spark):
    index = spark.range(100).withColumnRenamed("id", "i")
    other = spark.createDataFrame([(k,) for k in (1, 1, 2, 300, None)], "i long")
    rate = indexing.match_rate(index, other)
    assert "BroadcastHashJoin" not in plan_of(rate)
    assert tuple(rate.first()) == (100, 2, 2.0)


def test_feature_sums_join_in_bounded_tasks(spark, small_tasks):
    loans = spark.createDataFrame([(u, i, 0) for u in range(30) for i in range(10) for _ in range(2)], "u long, i long, t long")
    features = spark.createDataFrame([(i, f, 0.5) for i in range(9) for f in (i, 100)], "i long, feature long, weight double")
    sums = matrices.user_feature_sums(loans, features)
    assert "BroadcastHashJoin" not in plan_of(sums)
    found = {(r.u, r.feature): r.r for r in sums.collect()}
    assert found == {(u, f): 1.0 for u in range(30) for f in range(9)} | {(u, 100): 9.0 for u in range(30)}


def test_features_are_unrolled_where_their_user_is(spark, small_tasks):
    loans = spark.createDataFrame([(u, i, 0) for u in range(20) for i in (0, 0, 1, 2)] + [(None, 1, 0)], "u long, i long, t long")
    features = spark.createDataFrame([(0, 5, 1.0), (0, 5, 1.0), (0, 6, 0.5), (1, 6, 2.0), (7, 7, 1.0)], "i long, feature long, weight double")
    sums = matrices.user_feature_sums(loans, features)
    plan = plan_of(sums)
    # the (user, feature) rows are made after the last shuffle and need none
    assert "Generate explode" in plan and "Exchange" not in plan[: plan.index("Generate explode")]
    found = {(r.u, r.feature): r.r for r in sums.collect()}
    assert found == {(u, f): r for u in range(20) for f, r in ((5, 4.0), (6, 3.0))} | {(None, 6): 2.0}


def test_counted_pairs_stand_for_loans(spark, small_tasks):
    loans = spark.createDataFrame([(u, i, 0) for u in range(9) for i in (0, 0, 1)], "u long, i long, t long")
    pairs = matrices.counted(loans)
    assert pairs.rdd.getNumPartitions() >= 1 and "Aggregate" not in plan_of(matrices.user_item_counts(pairs))
    assert {(r.u, r.i): r.r for r in pairs.collect()} == {(u, i): 2.0 - i for u in range(9) for i in (0, 1)}
    items = spark.createDataFrame([(0, 3), (1, 3)], "i long, author_code long")
    by_loans, by_pairs = (sorted(map(tuple, matrices.user_author_matrix(x, items).collect())) for x in (loans, pairs))
    assert by_loans == by_pairs == [(u, 3, 3.0) for u in range(9)]
