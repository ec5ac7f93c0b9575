"""Canonical subjects: clustering near-equal tags and attaching rare ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import vectors as vec
from ..session import cut_lineage
from .blocks import dense_product, gram, sparse_product
from .encoders import ngram_tfidf
from .indexing import contiguous_index
from .spreading import spread

MERGE_DISTANCE = 0.25
ATTACH_SIMILARITY = 0.60


def exploded_subjects(items: DataFrame, key: str = "i") -> DataFrame:
    """One row per item and non-empty normalised tag. A small file is one task, so items are dealt out before their tags are read."""
    items = spread(items.select(key, "Subjects"), items.count(), key)
    tags = items.select(key, F.explode(F.split("Subjects", ";")).alias("subject"))
    return tags.select(key, tx.normalize_subject(F.col("subject")).alias("subject")).filter(F.col("subject") != "")


def subject_frequencies(exploded: DataFrame, min_frequent: int = 2) -> DataFrame:
    """``subject, n, frequent``."""
    counts = exploded.groupBy("subject").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("frequent", F.col("n") >= min_frequent)


def numbered_vectors(texts: DataFrame, low: int = 3, high: int = 5, min_df: int = 2) -> tuple[DataFrame, DataFrame]:
    """Distinct ``texts(subject)`` with a number each, and their n-gram rows ``id, mid, value``.

    The n-gram's hash stands for it on the shared axis.
    """
    numbered = contiguous_index(texts.select("subject").distinct(), ["subject"], "id")
    weights = ngram_tfidf(numbered, "subject", low, high, min_df)
    rows = weights.join(numbered, F.col("doc") == F.col("subject")).select(
        "id", F.xxhash64("term").alias("mid"), F.col("weight").alias("value")
    )
    return numbered, cut_lineage(rows)


def similar_pairs(vectors: DataFrame, above: float = 1 - MERGE_DISTANCE) -> DataFrame:
    """Pairs of ids with cosine above a bound: ``id_1 < id_2, similarity``."""
    found = gram(vectors, above=above)
    return found.filter(F.col("row_id") < F.col("col_id")).select(
        F.col("row_id").alias("id_1"), F.col("col_id").alias("id_2"), F.col("score").alias("similarity")
    )


def average_linkage(vectors: DataFrame, distance: float = MERGE_DISTANCE) -> DataFrame:
    """Average-linkage clusters under cosine distance, cut at ``distance``: ``id, cluster``.

    For unit vectors the average similarity of two clusters is the dot product of their mean vectors, so
    a round finds every cluster's closest partner with one blocked product, and all pairs that choose each
    other merge at once. Merging two clusters never brings a third one closer than it was to the nearer of
    the two, so this gives the same clusters as merging pair by pair; a cluster without a partner inside
    the bound is final. The closest pair of all always merges, hence the loop ends.
    """
    members = cut_lineage(vectors.select("id").distinct().withColumn("cluster", F.col("id")))
    active = cut_lineage(vectors.select(F.col("id").alias("cluster"), "mid", "value"))
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    while True:
        mean = active.join(sizes, "cluster").select(
            F.col("cluster").alias("id"), "mid", (F.col("value") / F.col("size")).alias("value")
        )
        closest = cut_lineage(
            gram(mean, k=1, above=1 - distance).select(
                F.col("row_id").alias("cluster"), F.col("col_id").alias("partner")
            )
        )
        back = closest.select(F.col("cluster").alias("partner"), F.col("partner").alias("cluster"))
        joined = closest.join(back, ["cluster", "partner"], "left_semi").filter(F.col("cluster") > F.col("partner"))
        moves = cut_lineage(joined.select("cluster", F.col("partner").alias("into")))
        if moves.isEmpty():
            return members
        target = F.coalesce("into", F.col("cluster"))
        members = cut_lineage(members.join(moves, "cluster", "left").select("id", target.alias("cluster")))
        sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
        active = cut_lineage(
            active.join(closest.select("cluster"), "cluster", "left_semi")
            .join(moves, "cluster", "left")
            .select(target.alias("cluster"), "mid", "value")
            .groupBy("cluster", "mid")
            .agg(F.sum("value").alias("value"))
        )


def name_clusters(clusters: DataFrame) -> DataFrame:
    """``subject, canonical`` from ``subject, n, cluster``: the most frequent, then shortest, then first tag."""
    first = F.min(F.struct(-F.col("n"), F.length("subject"), F.col("subject").alias("name")))
    names = clusters.groupBy("cluster").agg(first.alias("_first")).select("cluster", F.col("_first.name").alias("canonical"))
    return clusters.join(names, "cluster").select("subject", "canonical")


def canonical_map(frequencies: DataFrame, distance: float = MERGE_DISTANCE) -> DataFrame:
    """Canonical name of every frequent tag; tags without a shared n-gram stand for themselves."""
    frequent = frequencies.filter("frequent").select("subject", "n")
    numbered, vectors = numbered_vectors(frequent)
    clusters = average_linkage(vectors, distance).join(numbered, "id").select("subject", "cluster")
    named = name_clusters(clusters.join(frequent, "subject"))
    return frequent.join(named, "subject", "left").select(
        "subject", F.coalesce("canonical", F.col("subject")).alias("canonical")
    )


def _parents(singles: DataFrame, canonicals: DataFrame, best: DataFrame) -> DataFrame:
    names = canonicals.select(F.col("id").alias("col_id"), F.col("subject").alias("parent"))
    found = best.join(names, "col_id").select(F.col("row_id").alias("id"), "parent", F.col("score").alias("similarity"))
    return singles.select("id", "subject").join(found, "id", "left").select("subject", "parent", "similarity")


def attach_by_embedding(singles: DataFrame, canonicals: DataFrame, similarity: float = ATTACH_SIMILARITY) -> DataFrame:
    """Parent of each rare tag by embedding cosine; null when nothing is similar enough.

    Both inputs have ``id, subject, embedding``; canonical ids follow alphabetical order, so ties go to
    the first name. Blank tags and tags without an embedding are left out.
    """

    def ready(frame: DataFrame, key: str) -> DataFrame:
        usable = frame.filter((tx.strip_space(F.col("subject")) != "") & F.col("embedding").isNotNull())
        return usable.select(F.col("id").alias(key), vec.unit_exact(F.col("embedding")).alias("features"))

    # similarities are compared at nine digits, so "at least" means more than half a digit below
    best = dense_product(ready(singles, "row_id"), ready(canonicals, "col_id"), k=1, above=similarity - 5e-10)
    usable = singles.filter((tx.strip_space(F.col("subject")) != "") & F.col("embedding").isNotNull())
    return _parents(usable, canonicals, best)


def attach_by_ngrams(singles: DataFrame, canonicals: DataFrame, similarity: float = ATTACH_SIMILARITY) -> DataFrame:
    """The same with n-gram vectors over both vocabularies, where no embedding service is at hand."""
    # both are looked at several times, and may hold all the work of reading the tags
    singles, canonicals = cut_lineage(singles.select("subject").distinct()), cut_lineage(canonicals.select("subject").distinct())
    texts = singles.unionByName(canonicals)
    numbered, vectors = numbered_vectors(texts)
    singles = numbered.join(singles, "subject", "left_semi")
    canonicals = numbered.join(canonicals, "subject", "left_semi")
    left = vectors.join(singles.select("id"), "id", "left_semi")
    right = vectors.join(canonicals.select("id"), "id", "left_semi")
    best = sparse_product(
        left.withColumnRenamed("id", "row_id"),
        right.withColumnRenamed("id", "col_id"),
        k=1,
        above=similarity - 5e-10,
    )
    return _parents(singles, canonicals, best)


def unified_map(canonical: DataFrame, parents: DataFrame) -> DataFrame:
    """One ``subject, canonical`` table: frequent tags first, then attached rare ones."""
    attached = parents.filter(F.col("parent").isNotNull()).select("subject", F.col("parent").alias("canonical"))
    return canonical.unionByName(attached.join(canonical.select("subject"), "subject", "left_anti"))


def rebuild_subjects(items: DataFrame, exploded: DataFrame, names: DataFrame, key: str = "i") -> DataFrame:
    """Replace ``Subjects`` by the sorted canonical tags and add ``Subjects_fine`` with the plain ones.

    Tags without a canonical name drop out of the first list only; an empty list is null.
    """

    def joined(column: str):
        return F.array_join(F.array_sort(F.collect_set(column)), "; ")

    lists = (
        exploded.join(names, "subject", "left")
        .groupBy(key)
        .agg(joined("canonical").alias("_canonical"), joined("subject").alias("Subjects_fine"))
    )
    merged = items.join(lists, key, "left").withColumn("Subjects", F.nullif(F.col("_canonical"), F.lit("")))
    return merged.select(*items.columns, "Subjects_fine")
