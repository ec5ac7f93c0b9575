"""Rule bitmask ledger: each rule is evaluated once, its failure kept as a bit, its measurements beside it.

Policies are versions of a mask over those bits; applying or comparing them never reads a text again. A null or empty
text has no words and zero measurements and fails the length rule. Rows are judged one by one, so repeated rows get
equal results; other columns are left out of the ledger, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD

#: The symbols counted, in natural order.
SYMBOLS = r"[#*$%&|<>]"

#: Rule name -> SQL condition under which a text fails; the bit of a rule is its place in this table. Whole numbers only.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 12 * n_words",
    "many_symbols": "100 * n_symbols > 10 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "few_letter_words": "100 * n_letter_words < 70 * n_words",
    "shouting": "100 * n_capitals > 30 * word_chars",
    "many_exclamations": "100 * n_exclamations > 30 * n_words",
}


@dataclass(frozen=True)
class Policy:
    """A version of what is forbidden: a text is kept if it fails none of ``rules``."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(rule) for rule in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
POLICIES = (BASE, Policy("v1", tuple(RULES)[:6]), Policy("v2", tuple(RULES)))
CURRENT = POLICIES[-1]


def measure(documents: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id and the measurements, with ``carry`` also the whole row as the struct ``_row``.

    ``_words`` and the like are steps of their own so that each is computed once.
    """
    own = ["doc_id", *([F.struct("*").alias("_row")] if carry else [])]
    kept = ["doc_id", *(["_row"] if carry else [])]
    words = documents.select(*own, F.coalesce("text", F.lit("")).alias("_text")).withColumn(
        "_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0))
    )
    lines = F.filter(F.split("_text", "\n", -1), lambda line: F.rlike(line, F.lit(WORD)))
    n = F.size("_words")
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.col("_words")[i], F.col("_words")[i + 1], F.col("_words")[i + 2]),
        ),
    )
    split = words.withColumns({"_lines": lines, "_windows": windows})
    numbered = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    # most texts repeat no window: then nothing needs sorting
    ordered = F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(numbered))
    counted = split.select(
        *kept,
        n.cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        _count("_text", SYMBOLS).alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_words", lambda w: F.rlike(w, F.lit(r"\p{L}")))).cast("long").alias("n_letter_words"),
        _count("_text", "[A-Z]").alias("n_capitals"),
        _count("_text", "!").alias("n_exclamations"),
        ordered.alias("_ordered"),
    )
    return counted.withColumn("n_repeat_words", _covered("_ordered")).drop("_ordered")


def _count(column: str, pattern: str) -> Column:
    return F.regexp_count(F.col(column), F.lit(pattern)).cast("long")


def _covered(ordered: str) -> Column:
    """Words inside windows that have an equal neighbour in the order by window."""
    column = F.col(ordered)
    equal = lambda x, at: F.coalesce(F.get(column, at)["h"] == x["h"], F.lit(False))
    twice = F.filter(column, lambda x, i: equal(x, i - 1) | equal(x, i + 1))
    places = F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return F.when(column.isNull(), F.lit(0)).otherwise(F.size(F.array_distinct(places))).cast("long")


def ledger(documents: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, the measurements (with ``carry`` the row) and ``failed``, whose bit k is set if rule k fails."""
    bits = [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(RULES.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(documents, carry).withColumn("failed", failed.cast("long"))


def fails(policy: Policy) -> Column:
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) != 0


def ablations(entries: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """Per policy and rule: texts that fail it, and texts that would be kept without it.

    The ledger shrinks to one row per failure pattern first, so each policy works on at most 2 to the rules rows.
    """
    patterns = entries.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    names = list(RULES)
    cases = [F.struct(F.lit(p.version).alias("version"), F.lit(r).alias("rule"), F.lit(p.mask).cast("long").alias("mask"),
                      F.lit(1 << names.index(r)).cast("long").alias("bit")) for p in policies for r in p.rules]
    each = patterns.withColumn("c", F.explode(F.array(*cases))).select("failed", "n", "c.*")
    of = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    masked = F.col("failed").bitwiseAND(F.col("mask"))
    return each.groupBy("version", "rule").agg(
        of(F.col("failed").bitwiseAND(F.col("bit")) != 0).alias("n_failed"), of(masked == F.col("bit")).alias("n_only")
    )


def passing(documents: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The documents that ``policy`` keeps, all columns as they are."""
    # a filter is not pushed below a generated column: pushed down, it would evaluate every rule's measurements anew
    entries = ledger(documents, carry=True).select("_row", F.explode(F.array("failed")).alias("failed"))
    return entries.filter(~fails(policy)).select("_row.*")
