"""Order-based work on a loan log: repeat numbers, positions in a user's history, temporal splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import HOT_GROUP_ROWS, hot_keys, repeat_rows
from .spreading import spread

SECONDS_PER_DAY = 86_400


def positions(
    log: DataFrame, keys: list[str], order: list[str], segment: Column, hot_rows: int = HOT_GROUP_ROWS
) -> DataFrame:
    """Add ``position`` (from 0, by ``order``) and ``group_rows`` to every row of its ``keys`` group.

    ``keys + order`` must cover all columns, so rows equal in them are interchangeable. Groups that fit
    a task use one window. Groups above ``hot_rows`` collapse copies to counts, number rows inside
    ``segment`` slices (monotone in the first order column) and add the prefix sum of slice sizes.
    """
    columns = [*keys, *order]
    log = log.select(*columns)
    rows = log.count()
    hot = hot_keys(log, keys, hot_rows) if rows > hot_rows else None
    plain = spread(log if hot is None else log.join(hot, keys, "left_anti"), rows, *keys)
    group = Window.partitionBy(*keys)
    numbered = plain.withColumn(
        "position", (F.row_number().over(group.orderBy(*order)) - 1).cast("long")
    ).withColumn("group_rows", F.count(F.lit(1)).over(group))
    if hot is None:
        return numbered

    cells = (
        log.join(F.broadcast(hot) if hot.limit(100_001).count() <= 100_000 else hot, keys, "left_semi")
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_segment", segment)
    )
    before = Window.partitionBy(*keys).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        cells.groupBy(*keys, "_segment")
        .agg(F.sum("_copies").alias("_slice"))
        .withColumn("_offset", F.coalesce(F.sum("_slice").over(before), F.lit(0)))
        .withColumn("group_rows", F.sum("_slice").over(group))
        .drop("_slice")
    )
    inside = (
        Window.partitionBy(*keys, "_segment").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = cells.join(slices, [*keys, "_segment"]).withColumn(
        "_start", F.col("_offset") + F.coalesce(F.sum("_copies").over(inside), F.lit(0))
    )
    unrolled = repeat_rows(starts, "_copies", "_copy").select(
        *columns, (F.col("_start") + F.col("_copy")).alias("position"), "group_rows"
    )
    return numbered.unionByName(unrolled)


def clean_interactions(log: DataFrame, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """``u, i, t`` plus ``datetime`` and the repeat number of the loan within its (user, item) pair."""
    day = F.floor(F.col("t") / SECONDS_PER_DAY)
    return positions(log, ["u", "i"], ["t"], day, hot_rows).select(
        "u",
        "i",
        "t",
        F.timestamp_seconds("t").alias("datetime"),
        (F.col("position") + 1).cast("int").alias("interaction_rank"),
    )


def cut_points(rows: Column, test_size: float, val_size: float) -> tuple[Column, Column]:
    """First test position and first validation position of a history with ``rows`` loans."""
    if (test_size, val_size) == (0.2, 0.2):
        return F.floor(rows * 6 / 10), F.floor(rows * 8 / 10)
    return (
        F.floor(F.lit(1 - test_size - val_size) * rows),
        F.floor(F.lit(1 - val_size) * rows),
    )


def temporal_split(
    log: DataFrame,
    test_size: float = 0.2,
    val_size: float = 0.2,
    min_history: int = 3,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Label each loan ``train``, ``test`` or ``val`` by its place in the user's history.

    The oldest loans train, the next are test, the latest are validation. Users with fewer than
    ``min_history`` loans are in no split. Extra columns of ``log`` (a rank, a weight) take part in
    the ordering after time and item.
    """
    order = ["t", "i", *[name for name in log.columns if name not in ("u", "t", "i")]]
    day = F.floor(F.col("t") / SECONDS_PER_DAY)
    placed = positions(log, ["u"], order, day, hot_rows).filter(F.col("group_rows") >= min_history)
    test_from, val_from = cut_points(F.col("group_rows"), test_size, val_size)
    label = (
        F.when(F.col("position") < test_from, "train").when(F.col("position") < val_from, "test").otherwise("val")
    )
    return placed.select(*log.columns, label.alias("split"))


def select_split(labelled: DataFrame, *names: str) -> DataFrame:
    """Rows of the named splits; several names concatenate them."""
    return labelled.filter(F.col("split").isin(*names)).drop("split")
