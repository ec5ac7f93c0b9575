"""Contiguous indices and the checks on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_ROW_BITS = 33


def contiguous_index(rows: DataFrame, order: list, name: str = "idx") -> DataFrame:
    """Number ``rows`` 0..n-1 in ``order`` with a distributed sort.

    The sorted rows carry partition and row number; the prefix sums of partition sizes make them
    contiguous. The sort is written once, so both readers see the same partitions.
    """
    return number_sorted(rows.orderBy(*order), name)


def number_sorted(ordered: DataFrame, name: str) -> DataFrame:
    """Number the rows of a sorted frame 0..n-1 in its order."""
    marked = cut_lineage(ordered.withColumn("_mark", F.monotonically_increasing_id()))
    marked = marked.withColumn("_part", F.shiftright("_mark", _ROW_BITS))
    sizes = marked.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # one row per sorted partition, so one task and a broadcast are enough whatever the data size
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    row_number = F.col("_mark").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return marked.join(F.broadcast(offsets), "_part").select(*ordered.columns, (F.col("_offset") + row_number).alias(name))


def item_index(items: DataFrame) -> DataFrame:
    """``i, item_idx`` in catalogue (key) order."""
    return contiguous_index(items.select("i").distinct(), ["i"], "item_idx")


def user_index(loans: DataFrame) -> DataFrame:
    """``u, user_idx`` in order of each user's first loan."""
    first = loans.groupBy("u").agg(F.min(F.struct("t", "i")).alias("_first"))
    return contiguous_index(first, ["_first.t", "_first.i", "u"], "user_idx").select("u", "user_idx")


def with_indices(loans: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Loans with ``user_idx`` and ``item_idx``; loans outside either index drop out."""
    return loans.join(items, "i").join(users, "u")


def back_to_ids(scored: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Indices back to ids, columns otherwise unchanged."""
    return scored.join(items, "item_idx").join(users, "user_idx").drop("item_idx", "user_idx")


def uniqueness_check(cleaned: DataFrame) -> DataFrame:
    """Item ids given more than once and items without a title: both counts must be zero."""
    per_item = cleaned.groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("title_clean").isNull()).alias("untitled")
    )
    return per_item.agg(
        F.count_if(F.col("n") > 1).alias("duplicate_ids"), F.sum("untitled").alias("missing_titles")
    )


def index_violations(
    items: DataFrame,
    n_authors: int,
    n_publishers: int,
    item_subjects: DataFrame | None = None,
    n_subjects: int | None = None,
    n_embeddings: int | None = None,
) -> DataFrame:
    """Checks of an indexed catalogue as rows (check, violations); all zero means aligned."""
    seen = items.groupBy("item_idx").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.coalesce(F.col("author_code").between(0, n_authors - 1), F.lit(False))).alias("author"),
        F.count_if(~F.coalesce(F.col("publisher_code").between(0, n_publishers - 1), F.lit(False))).alias("publisher"),
    )
    totals = seen.agg(
        (F.sum("n") - F.count(F.lit(1))).alias("repeated_item_idx"),
        (F.greatest(-F.min("item_idx"), F.lit(0)) + F.abs(F.max("item_idx") + 1 - F.count(F.lit(1)))).alias(
            "item_idx_gaps"
        ),
        F.sum("author").alias("author_code_range"),
        F.sum("publisher").alias("publisher_code_range"),
    )
    if n_embeddings is not None:
        totals = totals.withColumn("embedding_rows", F.abs(F.lit(n_embeddings) - F.lit(items.count())))
    checks = [name for name in totals.columns]
    report = totals.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).cast("long").alias("violations")) for c in checks])
        ).alias("r")
    ).select("r.check", "r.violations")
    if item_subjects is not None:
        outside = F.coalesce(F.col("subject_idx").between(0, n_subjects - 1), F.lit(False))
        subjects = item_subjects.agg(
            F.count_if(~outside).alias("subject_idx_range"), F.count_if(F.col("weight") < 0).alias("negative_weights")
        )
        report = report.unionByName(
            subjects.select(
                F.explode(
                    F.array(
                        *[
                            F.struct(F.lit(c).alias("check"), F.col(c).cast("long").alias("violations"))
                            for c in subjects.columns
                        ]
                    )
                ).alias("r")
            ).select("r.check", "r.violations")
        )
    return report


def match_rate(index: DataFrame, other: DataFrame, key: str = "i") -> DataFrame:
    """How many indexed ids the other table knows."""
    found = other.select(key).distinct().withColumn("_found", F.lit(1))
    counts = index.join(found.hint("merge"), key, "left").agg(
        F.count(F.lit(1)).alias("n_items"), F.count("_found").alias("matched")
    )
    percent = F.round(F.try_divide(F.col("matched") * 100.0, F.col("n_items")), 1)
    return counts.withColumn("matched_pct", F.coalesce(percent, F.lit(0.0)))


def reindex_embeddings(index: DataFrame, embeddings: DataFrame, dim: int) -> DataFrame:
    """A vector for every indexed item; zeros where the embedding table has none."""
    zero = F.array_repeat(F.lit(0.0), dim)
    joined = index.join(embeddings.select("i", "embedding"), "i", "left")
    return joined.withColumn("embedding", F.coalesce("embedding", zero))


def reindex_weights(index: DataFrame, weights: DataFrame) -> DataFrame:
    """Item-subject weights of the indexed items. An item without any is a zero row: no subject and a weight of 0."""
    return index.join(weights, "i", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
