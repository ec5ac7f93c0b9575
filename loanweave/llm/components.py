"""Connected components of an edge table by spreading the smallest label, with labels followed to their own labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """id and label (the smallest id reachable) of every id in ``edges`` (a, b: long, any direction, no nulls).

    Every round takes the least label among the neighbours (partial minima before the shuffle), then the label of that
    label, so paths shorten about by half; each round's labels are written to the shared folder.
    """
    both = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        hooked = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        far = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        jumped = hooked.join(far, "label", "left").select("id", "old", F.coalesce("far", "label").alias("label"))
        fresh = written(jumped, "labels")
        labels = fresh.select("id", "label")
        if fresh.filter("old <> label").isEmpty():
            return labels
