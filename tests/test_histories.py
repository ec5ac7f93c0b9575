import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loanweave.operators import histories, skew


def log(spark, rows):
    return spark.createDataFrame(rows, "u long, i long, t long")


def skewed_rows():
    random.seed(3)
    rows = [(1, random.randrange(4), random.randrange(30) * 86_400 + random.randrange(3)) for _ in range(300)]
    rows += [(1, 2, 86_400)] * 200
    rows += [(u, random.randrange(4), random.randrange(10**6)) for u in range(2, 40) for _ in range(random.randrange(1, 9))]
    return rows


def test_hot_groups_rank_like_plain_ones(spark, monkeypatch):
    monkeypatch.setattr(skew, "COPIES_PER_CHUNK", 7)
    frame = log(spark, skewed_rows())
    plain = histories.clean_interactions(frame).collect()
    hot = histories.clean_interactions(frame, hot_rows=20).collect()
    assert Counter(map(tuple, plain)) == Counter(map(tuple, hot))
    by_pair = defaultdict(list)
    for u, i, t in sorted(skewed_rows(), key=lambda row: row[2]):
        by_pair[u, i].append(t)
    wanted = Counter((u, i, t, n + 1) for (u, i), times in by_pair.items() for n, t in enumerate(times))
    assert wanted == Counter((r.u, r.i, r.t, r.interaction_rank) for r in hot)


def test_hot_split_equals_plain_split(spark):
    frame = log(spark, skewed_rows())
    plain = histories.temporal_split(frame).collect()
    hot = histories.temporal_split(frame, hot_rows=20).collect()
    assert Counter(map(tuple, plain)) == Counter(map(tuple, hot))


@pytest.mark.parametrize("size,parts", [(1, None), (2, None), (3, (1, 1, 1)), (4, (2, 1, 1)), (5, (3, 1, 1)), (10, (6, 2, 2))])
def test_split_sizes_and_order(spark, size, parts):
    labelled = histories.temporal_split(log(spark, [(7, n, n * 100) for n in range(size)])).collect()
    found = Counter(row.split for row in labelled)
    if parts is None:
        assert not labelled
        return
    assert (found["train"], found["test"], found["val"]) == parts
    first = {name: min(r.t for r in labelled if r.split == name) for name in found}
    assert first["train"] < first["test"] < first["val"]


def test_other_ratios(spark):
    labelled = histories.temporal_split(log(spark, [(7, n, n) for n in range(10)]), test_size=0.1, val_size=0.3)
    assert Counter(r.split for r in labelled.collect()) == {"train": 6, "test": 1, "val": 3}


def test_select_split(spark):
    labelled = histories.temporal_split(log(spark, [(7, n, n) for n in range(10)]))
    assert histories.select_split(labelled, "train", "val").count() == 8


def test_repeat_rows_chunks(spark, monkeypatch):
    monkeypatch.setattr(skew, "COPIES_PER_CHUNK", 10)
    frame = spark.createDataFrame([("a", 3), ("b", 10), ("c", 37)], "k string, copies long")
    found = skew.repeat_rows(frame, "copies", "n").groupBy("k").agg(F.sort_array(F.collect_list("n")).alias("n")).collect()
    assert {row.k: row.n for row in found} == {"a": [0, 1, 2], "b": list(range(10)), "c": list(range(37))}
