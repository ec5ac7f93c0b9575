"""What the operators of this folder share: reading tables and cutting lineage with written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

#: Fixed value: words are runs of anything but space and the control characters tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ship_package(spark).read.parquet(f"{folder}/{name}.parquet")


def written(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written as Parquet below the shared checkpoint folder and read back.

    A lost executor costs a re-read of files that all machines see, never of local blocks.
    """
    spark = frame.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def split_by_frequency(rows: DataFrame, stats: DataFrame, keys: list[str], count: str, most: int = 100_000) -> DataFrame:
    """Inner join of ``rows`` with ``stats`` (one row per key, ``count`` rows of ``rows`` each), safe for hot keys.

    Keys with more than ``total / most`` rows are at most ``most`` in number whatever the data hold; they are
    broadcast. Every other key has at most that share of the rows, so the shuffled join is even.
    """
    total = stats.agg(F.sum(count)).first()[0] or 0
    limit = max(2_000, total // most)
    hot = stats.filter(F.col(count) > limit)
    cold = stats.filter(F.col(count) <= limit)
    if hot.isEmpty():
        return rows.join(cold, keys)
    warm = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return warm.join(cold, keys).unionByName(rows.join(F.broadcast(hot), keys))
