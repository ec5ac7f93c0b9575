"""The cover cache as a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

KEY = ["item_id", "size"]


def latest_rows(cache: DataFrame, order: str = "seq") -> DataFrame:
    """The last row per (item, size) by ``order``."""
    values = [name for name in cache.columns if name not in (*KEY, order)]
    return cache.groupBy(*KEY).agg(*[F.max_by(name, order).alias(name) for name in values])


def upsert(cache: DataFrame, updates: DataFrame) -> DataFrame:
    """Cache with the updates merged in on (item, size); write it to another path than it was read from."""
    kept = cache.join(updates.select(*KEY), KEY, "left_anti").select(*cache.columns)
    return kept.unionByName(updates.select(*cache.columns))


def cover_map(cache: DataFrame) -> DataFrame:
    """``item_id`` with a map from size to address, from latest rows."""
    entries = F.sort_array(F.collect_list(F.struct("size", "cover_url")))
    return cache.groupBy("item_id").agg(F.map_from_entries(entries).alias("covers"))


def coverage(items: DataFrame, cache: DataFrame) -> DataFrame:
    """Cached items, all items and the percentage."""
    cached = cache.select(F.col("item_id").alias("i")).distinct().withColumn("_cached", F.lit(1))
    counts = items.select("i").join(cached, "i", "left").agg(
        F.count("_cached").alias("cached_items"), F.count(F.lit(1)).alias("n_items")
    )
    percent = F.round(F.try_divide(F.col("cached_items") * 100.0, F.col("n_items")), 1)
    return counts.withColumn("cached_pct", F.coalesce(percent, F.lit(0.0)))


def cover_urls(items: DataFrame, cache: DataFrame, size: str = "M", placeholder: str = tx.NO_COVER) -> DataFrame:
    """Per item the addresses to try, the cached one first."""
    cached = cache.filter(F.col("size") == size).select(F.col("item_id").alias("i"), F.col("cover_url").alias("_cached"))
    found = tx.cover_candidates(F.col("ISBN Valid"), size, F.col("_cached"), placeholder)
    return items.join(cached, "i", "left").select("i", found.alias("cover_urls")).withColumn(
        "primary_url", F.element_at("cover_urls", 1)
    )


def refresh(items: DataFrame, cache: DataFrame, verified: DataFrame, size: str = "M") -> DataFrame:
    """New cache rows for uncached items: the first candidate that ``verified(cover_url)`` lists."""
    missing = items.join(
        cache.filter(F.col("size") == size).select(F.col("item_id").alias("i")), "i", "left_anti"
    )
    tries = missing.select("i", F.posexplode(tx.isbn_list(F.col("ISBN Valid"))).alias("pos", "isbn")).withColumn(
        "cover_url", F.format_string(tx.COVER_URL, "isbn", F.lit(size))
    )
    working = tries.join(verified.select("cover_url").distinct(), "cover_url", "left_semi")
    return (
        working.groupBy(F.col("i").alias("item_id"))
        .agg(F.min_by("isbn", "pos").alias("isbn"), F.min_by("cover_url", "pos").alias("cover_url"))
        .withColumn("size", F.lit(size))
    )


def cleared(cache: DataFrame) -> DataFrame:
    """An empty cache of the same shape."""
    return cache.limit(0)
