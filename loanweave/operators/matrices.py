"""Sparse user-by-feature matrices in long form, and user embeddings."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as vec
from ..session import cut_lineage, stored
from .routing import weighted_sums
from .spreading import look_up, spread


def user_item_counts(loans: DataFrame) -> DataFrame:
    """``u, i, r`` from loans; pairs that :func:`counted` made stay as they are."""
    if "r" in loans.columns:
        return loans.select("u", "i", "r")
    return loans.groupBy("u", "i").agg(F.count(F.lit(1)).cast("double").alias("r"))


def counted(loans: DataFrame) -> DataFrame:
    """The (user, item) counts written once; they stand for the loans wherever several matrices are made of these."""
    return stored(user_item_counts(spread(loans.select("u", "i"), loans.count(), "u", "i")))[0]


def user_item_weights(loans: DataFrame, weight: str) -> DataFrame:
    """Loans of a pair add up their ``weight`` column."""
    return loans.groupBy("u", "i").agg(F.sum(weight).cast("double").alias("r"))


def user_feature_sums(loans: DataFrame, features: DataFrame) -> DataFrame:
    """Weights of all features of all borrowed items per user: ``u, feature, r``.

    ``features`` holds ``i, feature, weight``. Loans collapse to (user, item) counts before the join. A pair takes its
    item's features along as one list to the task of its user, and they are unrolled and added up there.
    """
    rows = loans.count()
    pairs = spread(user_item_counts(loans), rows, "i")
    listed = cut_lineage(features.groupBy("i").agg(F.collect_list(F.struct("feature", "weight")).alias("own")))
    most = listed.agg(F.coalesce(F.avg(F.size("own")), F.lit(1.0))).first()[0]
    met = spread(pairs.join(listed.hint("merge"), "i").select("u", "r", "own"), math.ceil(rows * most), "u")
    each = met.select("u", "r", F.explode("own").alias("f"))
    return each.groupBy("u", F.col("f.feature").alias("feature")).agg(F.sum(F.col("r") * F.col("f.weight")).alias("r"))


def code_features(items: DataFrame, code: str) -> DataFrame:
    """One feature per item: its category code; items without a code have none."""
    return (
        items.select("i", F.col(code).alias("feature"), F.lit(1.0).alias("weight")).dropna(subset=["feature"]).distinct()
    )


def subject_features(item_subjects: DataFrame) -> DataFrame:
    return item_subjects.select("i", F.col("subject_idx").alias("feature"), "weight")


def user_author_matrix(loans: DataFrame, items: DataFrame) -> DataFrame:
    return user_feature_sums(loans, code_features(items, "author_code"))


def user_publisher_matrix(loans: DataFrame, items: DataFrame) -> DataFrame:
    return user_feature_sums(loans, code_features(items, "publisher_code"))


def user_subject_matrix(loans: DataFrame, item_subjects: DataFrame) -> DataFrame:
    """Sums of TF-IDF or multi-hot weights; every loan adds the item's whole subject vector."""
    return user_feature_sums(loans, subject_features(item_subjects))


def user_subject_counts(loans: DataFrame, cleaned: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Counts straight from the tag lists; a tag listed twice counts twice."""
    tags = cleaned.select("i", F.explode("subjects_list").alias("subject"))
    features = (
        look_up(tags, vocabulary, "subject")
        .groupBy("i", F.col("subject_idx").alias("feature"))
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    return user_feature_sums(loans, features)


def user_embeddings(loans: DataFrame, embeddings: DataFrame, dim: int, how: str = "mean") -> DataFrame:
    """Mean or sum of the vectors of all borrowed items; repeats count, unmatched items count as zeros.

    Users are summed in parts that get each item's vector once, so no vector travels per loan.
    """
    pairs = user_item_counts(loans)
    totals = pairs.groupBy("u").agg(F.sum("r").alias("loans"))
    entries = pairs.select(F.col("u").alias("target"), F.col("i").alias("other"), F.col("r").alias("weight"))
    vectors = embeddings.select(F.col("i").alias("other"), F.col("embedding").alias("features"))
    sums = weighted_sums(entries, vectors, dim).withColumnRenamed("target", "u")
    total = F.coalesce("total", vec.zeros(dim))
    value = total if how == "sum" else vec.scale(total, 1 / F.col("loans"))
    return totals.join(sums, "u", "left").select("u", value.alias("embedding"))
