"""How many rows a task gets, and which side of a join travels whole."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import task_slots

#: Rows that one task sorts or groups.
TASK_ROWS = 500_000
#: The most rows of a table that is sent whole to every task.
LOOKUP_ROWS = 100_000


def spread(frame: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``frame`` by ``keys`` in partitions of about ``TASK_ROWS`` of its ``rows``.

    Spark merges the partitions of its own shuffles by their compressed size, and repeated or ascending ids compress so
    well that 64 MB of them fill gigabytes once a task sorts them. A number of partitions that is asked for stays.
    """
    return frame.repartition(max(task_slots(frame.sparkSession), math.ceil(rows / TASK_ROWS)), *keys)


def look_up(rows: DataFrame, table: DataFrame, keys: str | list[str]) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which is written already and has the keys once.

    A counted, small table is broadcast. Else both sides are shuffled: by the sizes of compressed files Spark may judge
    the long side small, and would send it whole through the driver.
    """
    few = table.limit(LOOKUP_ROWS + 1).count() <= LOOKUP_ROWS
    return rows.join(F.broadcast(table) if few else table.hint("merge"), keys)
