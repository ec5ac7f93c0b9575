"""Registered queries on the test tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package

Run = Callable[[SparkSession, str], DataFrame]

RUNS: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``run(spark, folder)`` under ``name``, with the SQL to compare it to if there is one."""

    def register(run: Run) -> Run:
        def started(spark: SparkSession, folder: str) -> DataFrame:
            return run(ship_package(spark), folder)

        RUNS[name] = started
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def load() -> None:
    from . import cleaning, encoding, models, neighbours, reports, roundtrips, serving  # noqa: F401
