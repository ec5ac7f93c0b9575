"""From raw documents to packed training sequences: five stages, each written as Parquet and read by the next.

All stages but the last return the columns of ``documents``. Rows with a null text have no words and go with the first
stage; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweave.llm import decontamination, near_duplicates, packing, quality_rules, secret_scans
from loanweave.llm.common import table, written
from loanweave.session import ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of the rule ledger rejects go."""
    return quality_rules.passing(docs)


#: Least similarity of near duplicates in this stage, in per cent of five-word shingles; op6 has its own, 85.
NEAR_PER_CENT = 80


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group stays."""
    return near_duplicates.one_of_each(docs, per_cent=NEAR_PER_CENT).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with at most its budget of edits, go."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced by a mark; documents stay, and n_chars follows the text."""
    spans = "_spans"
    while spans in docs.columns:
        spans += "_"
    clean = secret_scans.redact(secret_scans.scan(docs, into=spans), spans=spans)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' tokens in sequences of 2048."""
    return packing.pack(docs)


#: In the order of the work: rules, near duplicates, benchmark items, secrets, sequences.
STAGES = [("quality", quality), ("dedup", dedup), ("decontaminate", decontaminate), ("secrets", secrets), ("pack", pack)]

#: The last stages need a tokenizer and an edit distance, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(ship_package(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
