"""Cleaning of the item catalogue and the reports and listings drawn from loans and items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .indexing import number_sorted


def one_row(*singles: DataFrame) -> DataFrame:
    """Single-row aggregates side by side, without a join."""
    stacked = singles[0]
    for single in singles[1:]:
        stacked = stacked.unionByName(single, allowMissingColumns=True)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def known_items(loans: DataFrame, items: DataFrame) -> DataFrame:
    """Loans of items the catalogue has."""
    return loans.join(items.select("i").distinct(), "i", "left_semi")


def interacted_items(items: DataFrame, loans: DataFrame) -> DataFrame:
    """Items with at least one loan."""
    return items.join(loans.select("i").distinct(), "i", "left_semi")


def cold_start_report(items: DataFrame, loans: DataFrame) -> DataFrame:
    borrowed = loans.select("i").distinct().withColumn("_seen", F.lit(1))
    counted = items.join(borrowed, "i", "left").agg(
        F.count(F.lit(1)).alias("n_items"), F.count_if(F.col("_seen").isNull()).alias("n_removed")
    )
    return counted.withColumn("removed_pct", F.round(F.try_divide(F.col("n_removed") * 100.0, F.col("n_items")), 1))


def clean_items(items: DataFrame, loans: DataFrame | None = None, remove_subjects: bool = False) -> DataFrame:
    """Cleaned metadata of the borrowed items (of all items when no loans are given)."""
    kept = items if loans is None else interacted_items(items, loans)
    cleaned = kept.select(
        "i",
        tx.clean_title(F.col("Title")).alias("title_clean"),
        F.col("Title").alias("title_original"),
        tx.author_label(F.col("Author")).alias("author_clean"),
        tx.clean_publisher(F.col("Publisher")).alias("publisher_clean"),
        tx.parse_subjects(F.col("Subjects")).alias("subjects_list"),
    ).withColumn("has_subjects", tx.has_any(F.col("subjects_list")))
    return drop_lone_subjects(cleaned) if remove_subjects else cleaned


def subject_rows(cleaned: DataFrame) -> DataFrame:
    """One row per (item, place in the list, tag)."""
    return cleaned.select("i", F.posexplode("subjects_list").alias("pos", "subject"))


def keep_subjects(cleaned: DataFrame, kept: DataFrame, column: str) -> DataFrame:
    """Add ``column``: the item's tags found in ``kept(subject)``, order and duplicates unchanged."""
    chosen = (
        subject_rows(cleaned)
        .join(kept.select("subject"), "subject", "left_semi")
        .groupBy("i")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "subject"))).alias("_kept"))
        .select("i", F.col("_kept.subject").alias("_kept"))
    )
    filled = F.coalesce(F.col("_kept"), F.array().cast("array<string>"))
    return cleaned.join(chosen, "i", "left").withColumn(column, filled).drop("_kept")


def drop_lone_subjects(cleaned: DataFrame) -> DataFrame:
    """Remove tags only one item carries; ``has_subjects`` keeps its earlier value."""
    spread = (
        subject_rows(cleaned)
        .select("i", "subject")
        .distinct()
        .groupBy("subject")
        .agg(F.count(F.lit(1)).alias("items"))
        .filter("items <> 1")
    )
    return keep_subjects(cleaned, spread, "subjects_list").select(*cleaned.columns)


def item_counts(loans: DataFrame, name: str = "borrow_count") -> DataFrame:
    return loans.groupBy("i").agg(F.count(F.lit(1)).alias(name))


def items_with_counts(items: DataFrame, loans: DataFrame, name: str = "borrow_count") -> DataFrame:
    """Every item with its loan count, zero where there is none."""
    return items.join(item_counts(loans, name), "i", "left").fillna(0, [name])


def top_items(loans: DataFrame, n: int) -> DataFrame:
    return item_counts(loans).orderBy(F.desc("borrow_count"), "i").limit(n)


def repeat_distribution(loans: DataFrame) -> DataFrame:
    """How many (user, item) pairs have 1, 2, 3, ... loans."""
    pairs = loans.groupBy("u", "i").agg(F.count(F.lit(1)).alias("repeats"))
    return pairs.groupBy("repeats").agg(F.count(F.lit(1)).alias("n_pairs"))


def interaction_stats(loans: DataFrame) -> DataFrame:
    """Counts and date range; distinct counts go through grouped keys, so no task holds a key set."""
    users = loans.groupBy("u").agg(F.count(F.lit(1)).alias("rows"), F.min("t").alias("lo"), F.max("t").alias("hi"))
    totals = users.agg(
        F.sum("rows").alias("n_interactions"),
        F.count(F.lit(1)).alias("n_users"),
        F.min("lo").alias("first_t"),
        F.max("hi").alias("last_t"),
    )
    items = loans.select("i").distinct().agg(F.count(F.lit(1)).alias("n_items"))
    return one_row(totals, items).select("n_interactions", "n_users", "n_items", "first_t", "last_t")


def user_stats(loans: DataFrame) -> DataFrame:
    pairs = loans.groupBy("u", "i").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi"))
    return pairs.groupBy("u").agg(
        F.sum("n").alias("total_borrows"),
        F.count(F.lit(1)).alias("unique_books"),
        F.min("lo").alias("first_borrow"),
        F.max("hi").alias("last_borrow"),
    )


def user_history(loans: DataFrame, items: DataFrame, user: int | None = None) -> DataFrame:
    """Loans per (user, item) with the item's metadata; one user or all of them."""
    chosen = loans if user is None else loans.filter(F.col("u") == user)
    counts = chosen.groupBy("u", "i").agg(F.count(F.lit(1)).alias("times_borrowed"))
    return counts.join(items, "i", "left")


def overview_kpis(loans: DataFrame, items: DataFrame) -> DataFrame:
    users = loans.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    totals = users.agg(F.count(F.lit(1)).alias("total_users"), F.sum("n").alias("total_borrows"))
    books = items.agg(F.count(F.lit(1)).alias("total_books"))
    return one_row(totals, books).select(
        "total_users",
        "total_books",
        "total_borrows",
        F.round(F.try_divide("total_borrows", "total_users"), 1).alias("borrows_per_user"),
    )


def user_kpis(loans: DataFrame) -> DataFrame:
    per_book = F.coalesce(F.try_divide("total_borrows", "unique_books"), F.lit(0.0))
    return user_stats(loans).select("u", "total_borrows", "unique_books", F.round(per_book, 1).alias("borrows_per_book"))


def item_stats(cleaned: DataFrame) -> DataFrame:
    """Coverage of tags, authors and publishers as percent strings."""

    def share(holds: Column) -> Column:
        percent = F.round(F.try_divide(F.count_if(holds) * 100.0, F.count(F.lit(1))), 2)
        return F.concat(percent.cast("string"), F.lit("%"))

    return cleaned.agg(
        F.count(F.lit(1)).alias("n_items"),
        share(F.col("has_subjects")).alias("n_items_with_subjects"),
        share(F.col("author_clean") != tx.UNKNOWN).alias("n_items_with_authors"),
        share(F.col("publisher_clean") != tx.UNKNOWN).alias("n_items_with_publishers"),
    )


def metadata_coverage(items: DataFrame) -> DataFrame:
    """Filled share and distinct values per metadata field, one pass over the fields."""
    fields = ["Title", "Author", "Publisher", "Subjects"]
    entries = F.array(*[F.struct(F.lit(name).alias("field"), F.col(name).alias("value")) for name in fields])
    values = items.select(F.explode(entries).alias("e")).groupBy("e.field", "e.value").agg(F.count(F.lit(1)).alias("n"))
    filled = F.sum(F.when(F.col("value").isNull(), 0).otherwise(F.col("n")))
    return values.groupBy("field").agg(
        filled.alias("n_filled"),
        F.count("value").alias("n_distinct"),
        F.round(filled * 100.0 / F.sum("n"), 2).alias("filled_pct"),
    )


def orphan_loans(loans: DataFrame, items: DataFrame) -> DataFrame:
    return loans.join(items.select("i").distinct(), "i", "left_anti").agg(F.count(F.lit(1)).alias("n_orphans"))


def sparsity(loans: DataFrame) -> DataFrame:
    """Sparsity by loans and by distinct pairs, with the repeat-loan figures."""
    pairs = loans.groupBy("u", "i").agg(F.count(F.lit(1)).alias("n"))
    totals = pairs.agg(
        F.sum("n").alias("n_interactions"),
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if(F.col("n") > 1).alias("repeat_pairs"),
        F.sum(F.col("n") - 1).alias("repeat_interactions"),
    )
    users = pairs.select("u").distinct().agg(F.count(F.lit(1)).alias("n_users"))
    items = pairs.select("i").distinct().agg(F.count(F.lit(1)).alias("n_items"))
    cells = F.col("n_users") * F.col("n_items")
    return (
        one_row(totals, users, items)
        .withColumn("sparsity_pct", F.round((1 - F.col("n_interactions") / cells) * 100, 4))
        .withColumn("pair_sparsity_pct", F.round((1 - F.col("n_pairs") / cells) * 100, 4))
    )


def bucket_label(value: Column, uppers: list[int]) -> Column:
    """Name of the closed range ``value`` falls in; the last range is open."""
    label, low = None, 1
    for upper in uppers:
        name = str(upper) if low == upper else f"{low}-{upper}"
        label = F.when(value <= upper, name) if label is None else label.when(value <= upper, name)
        low = upper + 1
    return label.otherwise(f"{low}+")


def activity_buckets(loans: DataFrame, key: str, uppers: list[int]) -> DataFrame:
    """Histogram of loans per ``key`` over the given ranges, with the share of each."""
    sizes = loans.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return _shares(sizes.select(bucket_label(F.col("n"), uppers).alias("bucket")))


def subjects_per_item_buckets(cleaned: DataFrame, uppers: list[int]) -> DataFrame:
    sizes = cleaned.filter("has_subjects").select(F.size("subjects_list").alias("n"))
    return _shares(sizes.select(bucket_label(F.col("n"), uppers).alias("bucket")))


def _shares(labelled: DataFrame) -> DataFrame:
    counts = labelled.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_keys"))
    # the window runs over one row per range
    everything = F.sum("n_keys").over(Window.partitionBy())
    return counts.withColumn("pct", F.round(F.col("n_keys") * 100.0 / everything, 1))


def subject_counts(cleaned: DataFrame) -> DataFrame:
    """Occurrences of each tag over all items."""
    return (
        cleaned.select(F.explode("subjects_list").alias("subject"))
        .groupBy("subject")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_subjects(cleaned: DataFrame, n: int = 15) -> DataFrame:
    return subject_counts(cleaned).orderBy(F.desc("n"), "subject").limit(n)


def subjects_near_cutoff(cleaned: DataFrame, min_freq: int, spread: int = 3) -> DataFrame:
    """The tags just above and just below a frequency cut-off, most frequent first."""
    counts = subject_counts(cleaned)
    above = counts.filter(F.col("n") >= min_freq).orderBy("n", F.desc("subject")).limit(spread)
    below = counts.filter(F.col("n") < min_freq).orderBy(F.desc("n"), "subject").limit(spread)
    return above.unionByName(below).withColumn("in_vocab", F.col("n") >= min_freq)


def data_profile(frame: DataFrame, name: str, key: str) -> DataFrame:
    """Row count, column list and key range of a table."""
    return frame.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("min_key"), F.max(key).alias("max_key")
    ).select(
        F.lit(name).alias("table_name"),
        F.lit(len(frame.columns)).alias("n_columns"),
        F.lit(",".join(frame.columns)).alias("columns"),
        "n_rows",
        "min_key",
        "max_key",
    )


def search_users(stats: DataFrame, pattern: str) -> DataFrame:
    """Users whose id, as text, matches the regular expression."""
    return stats.filter(F.col("u").cast("string").rlike(pattern))


def sort_users(stats: DataFrame, by: str = "total_borrows") -> DataFrame:
    return stats.orderBy("u") if by == "u" else stats.orderBy(F.desc(by), "u")


def search_items(items: DataFrame, title: str = "", author: str = "", literal: bool = False) -> DataFrame:
    """Case-insensitive title and author search; patterns are regular expressions unless ``literal``."""
    found = items
    for column, wanted in (("Title", title), ("Author", author)):
        if not wanted:
            continue
        lowered = F.lower(F.col(column))
        hit = lowered.contains(wanted.lower()) if literal else lowered.rlike(wanted.lower())
        found = found.filter(F.coalesce(hit, F.lit(False)))
    return found


def sort_items(listing: DataFrame, by: str = "borrow_count") -> DataFrame:
    if by == "borrow_count":
        return listing.orderBy(F.desc("borrow_count"), "i")
    return listing.orderBy(F.asc_nulls_last(by), "i")


def page_bounds(total: Column | int, page: Column | int, per_page: int) -> tuple[Column, Column]:
    """Total pages (at least one) and the requested page clamped into them."""
    total, page = (value if isinstance(value, Column) else F.lit(value) for value in (total, page))
    pages = F.greatest(F.lit(1).cast("long"), F.ceil(total / per_page))
    return pages, F.greatest(F.lit(0).cast("long"), F.least(page, pages - 1))


def page_summary(listing: DataFrame, page: int, per_page: int) -> DataFrame:
    pages, current = page_bounds(F.col("total_rows"), page, per_page)
    return listing.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows", pages.alias("total_pages"), current.alias("page")
    )


def page_of(ordered: DataFrame, page: int, per_page: int) -> DataFrame:
    """One page of an ordered listing; out-of-range pages give the nearest one.

    Rows are numbered in place after the distributed sort, so a late page does not send all earlier rows to one task.
    """
    numbered = number_sorted(ordered, "_place")
    total = numbered.count()
    last = max(1, -(-total // per_page)) - 1
    start = min(max(page, 0), last) * per_page
    return numbered.filter(F.col("_place").between(start, start + per_page - 1)).orderBy("_place").drop("_place")


def page_after(listing: DataFrame, by: str, value, item: int, per_page: int) -> DataFrame:
    """Page following a known row in a descending listing; depth does not add cost."""
    later = (F.col(by) < value) | ((F.col(by) == value) & (F.col("i") > item))
    return listing.filter(later).orderBy(F.desc(by), "i").limit(per_page)


def sample_items(items: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """A random handful of items; the seed fixes the draw per item whatever the partitioning."""
    return items.orderBy(F.xxhash64("i", F.lit(seed)), "i").limit(n)


def display_cards(items: DataFrame, width: int = 60, size: str = "M") -> DataFrame:
    """Item fields as a card shows them: escaped, shortened, with defaults and cover addresses."""
    return items.select(
        "i",
        tx.shorten(tx.escape_html(F.coalesce("Title", F.lit("Unknown Title"))), width).alias("title"),
        tx.escape_html(F.coalesce("Author", F.lit("Unknown Author"))).alias("author"),
        tx.escape_html(F.coalesce("Publisher", F.lit("Unknown Publisher"))).alias("publisher"),
        tx.subject_badges(F.col("Subjects")).alias("badges"),
        tx.cover_candidates(F.col("ISBN Valid"), size).alias("cover_urls"),
    )
