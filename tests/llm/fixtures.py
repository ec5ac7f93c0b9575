"""Small document tables with the awkward rows that every operator must stand."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in "th er in on at en nd st re ti".split() for b in "ar el om ush ing ed le".split()]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def awkward() -> list[tuple]:
    """Nulls in every column, empty and blank texts, repeated rows and ids, one long text."""
    long = prose(99, 30_000)
    rows = [
        (1, prose(1, 80), "en", "a", 1),
        (1, prose(1, 80), "en", "a", 1),
        (2, prose(1, 80), None, None, None),
        (3, None, "en", "a", None),
        (4, "", "fr", "a", 0),
        (5, " \n\t ", None, "b", 4),
        (None, prose(5, 60), "en", "a", 1),
        (None, None, None, None, None),
        (6, long, "en", "a", len(long)),
        (7, "one two", "en", "a", 7),
        (8, "One TWO", "en", "a", 7),
    ]
    return rows


def frame(spark, rows=None, extra: bool = False):
    found = spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
    if extra:
        # names that operators use inside or in their results
        for name in ("kept", "_text", "_words", "label", "value", "id", "size", "vslot", "tag", "spans", "failed", "verdict", "_row"):
            from pyspark.sql import functions as F

            found = found.withColumn(name, F.lit("x"))
    return found


def rows_of(frame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=repr)
