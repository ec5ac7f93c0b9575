"""Category codes, subject vocabularies and TF-IDF weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import cut_lineage
from .catalog import keep_subjects, subject_counts, subject_rows
from .indexing import contiguous_index
from .spreading import look_up


def fit_categories(values: DataFrame, column: str, threshold: int, rare_label: str) -> DataFrame:
    """Encoder table ``label, code, frequent``: values under the threshold share the rare label."""
    counts = values.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    frequent = F.col("n") >= threshold
    labels = (
        counts.select(F.when(frequent, F.col("value")).otherwise(rare_label).alias("label"), frequent.alias("frequent"))
        .groupBy("label")
        .agg(F.max("frequent").alias("frequent"))
    )
    return contiguous_index(labels, ["label"], "code").select("label", "code", "frequent")


def apply_categories(values: DataFrame, column: str, encoder: DataFrame, rare_label: str, name: str) -> DataFrame:
    """Add the code of ``column``; an unseen value takes the rare code, null if no class was rare."""
    rare = encoder.filter(F.col("label") == rare_label).select("code").first()
    rare_code = F.lit(rare.code if rare else None).cast("long")
    known = encoder.filter("frequent").select(F.col("label").alias(column), F.col("code").alias("_code"))
    return values.join(known, column, "left").withColumn(name, F.coalesce("_code", rare_code)).drop("_code")


def encode_authors(cleaned: DataFrame, threshold: int = 2) -> tuple[DataFrame, DataFrame]:
    encoder = fit_categories(cleaned, "author_clean", threshold, tx.RARE_AUTHOR)
    return apply_categories(cleaned, "author_clean", encoder, tx.RARE_AUTHOR, "author_code"), encoder


def encode_publishers(cleaned: DataFrame, threshold: int = 3) -> tuple[DataFrame, DataFrame]:
    encoder = fit_categories(cleaned, "publisher_clean", threshold, tx.RARE_PUBLISHER)
    return apply_categories(cleaned, "publisher_clean", encoder, tx.RARE_PUBLISHER, "publisher_code"), encoder


def frequent_subjects(cleaned: DataFrame, min_count: int = 6) -> DataFrame:
    return subject_counts(cleaned).filter(F.col("n") >= min_count)


def clean_subjects(cleaned: DataFrame, min_count: int = 6) -> tuple[DataFrame, DataFrame]:
    """Items with ``subjects_clean`` (tags seen at least ``min_count`` times) and the valid tags."""
    valid = frequent_subjects(cleaned, min_count)
    return keep_subjects(cleaned, valid, "subjects_clean"), valid


def subject_vocabulary(cleaned: DataFrame, min_freq: int = 5, max_features: int | None = None) -> DataFrame:
    """Frequent tags numbered alphabetically: ``subject, subject_idx, n``; only the first ``max_features`` if that is given."""
    kept = frequent_subjects(cleaned, min_freq)
    if max_features is not None:
        kept = kept.orderBy(F.desc("n"), "subject").limit(max_features)
    return contiguous_index(kept, ["subject"], "subject_idx").select("subject", "subject_idx", "n")


def number_subjects(subjects: DataFrame) -> DataFrame:
    """Alphabetical index over the given tags."""
    return contiguous_index(subjects.select("subject").distinct(), ["subject"], "subject_idx")


def multi_hot(cleaned: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Item-subject incidence as rows ``i, subject_idx, weight``."""
    tags = cleaned.select("i", F.explode(F.array_distinct("subjects_list")).alias("subject"))
    return look_up(tags, vocabulary, "subject").select("i", "subject_idx", F.lit(1.0).alias("weight"))


def item_subject_index(cleaned: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Subject indices per item in list order, duplicates kept; items without any have no row."""
    return look_up(subject_rows(cleaned), vocabulary, "subject").select("i", "pos", "subject_idx")


def tfidf(postings: DataFrame, n_docs: int, min_df: int = 1) -> DataFrame:
    """Unit-length TF-IDF rows ``doc, term, weight`` from one ``doc, term`` row per occurrence.

    Uses the smoothed inverse frequency ``ln((1 + n) / (1 + df)) + 1``; ``n_docs`` counts every document,
    also those that end up without terms.
    """
    counts = postings.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"))
    spread = cut_lineage(counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= min_df))
    idf = F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0
    raw = look_up(counts, spread, "term").select("doc", "term", (F.col("tf") * idf).alias("raw"))
    # a document is one input row, so its terms fit a window group
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("doc")))
    return raw.select("doc", "term", (F.col("raw") / length).alias("weight"))


def subject_tfidf(cleaned: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """TF-IDF of each item's tags over the vocabulary: ``i, subject_idx, weight``; others are zero rows."""
    tags = item_subject_index(cleaned, vocabulary).select(F.col("i").alias("doc"), F.col("subject_idx").alias("term"))
    weighted = tfidf(tags, cleaned.count())
    return weighted.select(F.col("doc").alias("i"), F.col("term").alias("subject_idx"), "weight")


def ngram_tfidf(texts: DataFrame, column: str, low: int = 3, high: int = 5, min_df: int = 2) -> DataFrame:
    """Character n-gram TF-IDF of distinct texts: ``doc`` (the text), ``term`` (the n-gram), ``weight``."""
    grams = texts.select(F.col(column).alias("doc"), F.explode(tx.char_ngrams(F.col(column), low, high)).alias("term"))
    return tfidf(grams, texts.count(), min_df)
