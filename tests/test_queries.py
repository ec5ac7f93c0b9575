"""Every registered query against its SQL on the smallest tables; those without SQL must give rows."""

import duckdb
import pytest

import __spark_entry__ as registered
from compare import TABLES, sorted_rows

FOLDER = "/root/testdata/sf0.001"
RUNS, SQL = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    base = duckdb.connect()
    for name in TABLES.split():
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return base


def close(mine, theirs):
    """Equal but for doubles that round differently in the last shown digit."""
    if len(mine) != len(theirs):
        return False
    for a, b in zip(mine, theirs):
        for x, y in zip(a, b):
            if x != y and not (isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 1.1e-6 * max(1, abs(x))):
                return False
    return True


@pytest.mark.parametrize("name", sorted(RUNS))
def test_query(spark, duck, name):
    frame = RUNS[name](spark, FOLDER)
    columns, rows = sorted_rows(frame.columns, [tuple(row) for row in frame.collect()])
    if name not in SQL:
        assert rows
        return
    found = duck.execute(SQL[name])
    wanted_columns, wanted = sorted_rows([d[0] for d in found.description], found.fetchall())
    assert columns == wanted_columns
    assert close(rows, wanted)


def test_entry(spark):
    result = registered.entry(spark)
    assert result.columns == ["user_id", "recommendation"]
    assert result.count() > 0
