"""Finding and re-expanding hot groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_GROUP_ROWS = 2_000_000
COPIES_PER_CHUNK = 65_536


def hot_keys(rows: DataFrame, keys: list[str], limit: int = HOT_GROUP_ROWS) -> DataFrame | None:
    """Keys with more than ``limit`` rows, or None when there are none.

    One pass with map-side partial counts; at most ``rows / limit`` keys come out of it.
    """
    hot = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit).select(*keys)
    return None if hot.isEmpty() else hot


def repeat_rows(frame: DataFrame, copies: str, number: str) -> DataFrame:
    """One output row per copy, ``number`` counting from 0, without one task unrolling a huge count.

    Large counts are first unrolled to chunk numbers and spread over the cluster.
    """
    small = frame.filter(F.col(copies) <= COPIES_PER_CHUNK).withColumn(
        number, F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1))
    )
    chunk_last = F.floor((F.col(copies) - 1) / COPIES_PER_CHUNK)
    large = (
        frame.filter(F.col(copies) > COPIES_PER_CHUNK)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunk_last)))
        .repartition("_chunk")
        .withColumn("_from", F.col("_chunk") * COPIES_PER_CHUNK)
        .withColumn("_to", F.least(F.col("_from") + COPIES_PER_CHUNK, F.col(copies)) - 1)
        .withColumn(number, F.explode(F.sequence("_from", "_to")))
        .drop("_chunk", "_from", "_to")
    )
    return small.unionByName(large)
