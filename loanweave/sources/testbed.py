"""Loans, items and embeddings shaped from the order, part and embedding tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.spreading import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def epoch_seconds(stamp: Column) -> Column:
    """Seconds since 1970 of a zone-less timestamp, whatever the session's zone."""
    return F.timestamp_diff("SECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), stamp.cast("timestamp_ntz"))


def loans(spark: SparkSession, folder: str) -> DataFrame:
    """``u`` = customer, ``i`` = part, ``t`` = ship date."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("u"))
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("i"), epoch_seconds(F.col("l_shipdate")).alias("t")
    )
    rows = lines.count()
    lines, orders = spread(lines, rows, "l_orderkey"), spread(orders, rows, "o_orderkey")
    return lines.join(orders.hint("merge"), lines.l_orderkey == orders.o_orderkey).select("u", "i", "t")


def visits(spark: SparkSession, folder: str) -> DataFrame:
    """A log with many repeats per pair: ``u`` = user, ``i`` = event type (by number), ``t`` = time."""
    kinds = F.array(*[F.lit(kind) for kind in ("click", "error", "purchase", "signup", "view")])
    return table(spark, folder, "events").select(
        F.col("user_id").alias("u"),
        F.array_position(kinds, F.col("event_type")).alias("i"),
        epoch_seconds(F.col("ts")).alias("t"),
    )


def two_digits(number: Column) -> Column:
    return F.lpad((number % 100).cast("string"), 2, "0")


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Catalogue rows with the flaws the cleaners expect: stray spaces, slashes, years, empty tags, nulls."""
    key, name, brand, kind = F.col("p_partkey"), F.col("p_name"), F.col("p_brand"), F.col("p_type")
    words = F.split(name, " ")
    year = F.concat(F.lit("19"), two_digits(key))
    author = F.concat(brand, F.lit(", "), name, F.lit(", "), year, F.lit("-"))
    phrase = F.concat(name, F.lit(" -- "), brand, F.lit(", "), year)
    tags = [F.upper(words[0]), words[1], F.lit(""), kind, brand, phrase]
    isbn13 = F.concat(F.lit("978-"), F.lpad(key.cast("string"), 10, "0"))
    isbn10 = F.concat(F.lpad(key.cast("string"), 9, "0"), F.lit("-x"))
    return table(spark, folder, "part").select(
        F.concat(F.lit("  "), name, F.lit("  /")).alias("Title"),
        F.when(key % 7 != 0, author).alias("Author"),
        F.concat_ws(" ; ", isbn13, isbn10).alias("ISBN Valid"),
        F.when(
            key % 11 != 0, F.concat_ws("  ", brand, kind, (F.col("p_size") % 10).cast("string"))
        ).alias("Publisher"),
        F.when(key % 9 != 0, F.concat_ws(" ; ", *tags)).alias("Subjects"),
        key.alias("i"),
    )


def items_with_second_author(spark: SparkSession, folder: str) -> DataFrame:
    """The catalogue with a second, sometimes equal, author on every fifth item."""
    second = F.concat(F.lit(" & "), F.element_at(F.split("Author", ","), 1), F.lit(", Ann, 1950-"))
    again = F.concat(F.lit(" ; "), F.col("Author"))
    return items(spark, folder).withColumn(
        "Author", F.when(F.col("i") % 5 == 0, F.concat("Author", second, again)).otherwise(F.col("Author"))
    )


def item_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """``i`` with a vector of doubles; only part of the items has one."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("i"), F.col("embedding").cast("array<double>").alias("embedding")
    )


def covers(spark: SparkSession, folder: str) -> DataFrame:
    """A cover cache with rewritten rows: small-format items cached in two sizes, the smallest twice, in ``seq`` order."""
    base = table(spark, folder, "part").filter("p_size <= 20").select(F.col("p_partkey").alias("item_id"), "p_size")
    first = base.select("item_id", F.explode(F.array(F.lit("S"), F.lit("M"))).alias("size"), F.lit(0).alias("seq"))
    later = base.filter("p_size <= 10").select("item_id", F.lit("M").alias("size"), F.lit(1).alias("seq"))
    isbn = F.concat(F.lit("978"), F.lpad(F.col("item_id").cast("string"), 10, "0"))
    return first.unionByName(later).select(
        "item_id",
        isbn.alias("isbn"),
        F.concat(F.lit("https://covers.example/"), isbn, F.lit("-"), "size", F.lit("-v"), F.col("seq").cast("string"))
        .alias("cover_url"),
        "size",
        "seq",
    )


def cover_updates(spark: SparkSession, folder: str) -> DataFrame:
    """New cover rows in size M, for cached and for new items."""
    isbn = F.concat(F.lit("979"), F.lpad(F.col("p_partkey").cast("string"), 10, "0"))
    return table(spark, folder, "part").filter("p_size > 15").select(
        F.col("p_partkey").alias("item_id"),
        isbn.alias("isbn"),
        F.concat(F.lit("https://covers.example/"), isbn, F.lit("-M-v9")).alias("cover_url"),
        F.lit("M").alias("size"),
        F.lit(9).alias("seq"),
    )
