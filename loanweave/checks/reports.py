"""Histories, statistics and listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog, histories
from ..session import cut_lineage
from ..sources import testbed as bed
from . import query
from .fragments import statement


@query("interaction_rank", statement("loans ranked", "SELECT u, i, t, CAST(interaction_rank AS INT) AS interaction_rank FROM ranked"))
def interaction_rank(spark, folder):
    return histories.clean_interactions(bed.loans(spark, folder)).drop("datetime")


@query(
    "event_repeat_rank",
    """SELECT user_id AS u,
              CAST(list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) AS BIGINT) AS i,
              CAST(floor(epoch(ts)) AS BIGINT) AS t,
              CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY floor(epoch(ts))) AS INT) AS interaction_rank
       FROM events""",
)
def event_repeat_rank(spark, folder):
    return histories.clean_interactions(bed.visits(spark, folder)).drop("datetime")


@query("temporal_split", statement("loans split", "SELECT u, i, t, split FROM split"))
def temporal_split(spark, folder):
    return histories.temporal_split(bed.loans(spark, folder))


@query(
    "split_sizes",
    statement("loans split", "SELECT split, count(*) AS n_rows, count(DISTINCT u) AS n_users FROM split GROUP BY split"),
)
def split_sizes(spark, folder):
    per_user = histories.temporal_split(bed.loans(spark, folder)).groupBy("split", "u").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("split").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_users"))


@query(
    "repeat_distribution",
    statement(
        "loans ratings", "SELECT CAST(r AS BIGINT) AS repeats, count(*) AS n_pairs FROM ratings GROUP BY r"
    ),
)
def repeat_distribution(spark, folder):
    return catalog.repeat_distribution(bed.loans(spark, folder))


@query(
    "event_repeat_distribution",
    """SELECT repeats, count(*) AS n_pairs
       FROM (SELECT count(*) AS repeats FROM events GROUP BY user_id, event_type) GROUP BY repeats""",
)
def event_repeat_distribution(spark, folder):
    return catalog.repeat_distribution(bed.visits(spark, folder))


@query(
    "interaction_stats",
    statement(
        "loans",
        """SELECT count(*) AS n_interactions, count(DISTINCT u) AS n_users, count(DISTINCT i) AS n_items,
                  min(t) AS first_t, max(t) AS last_t FROM loans""",
    ),
)
def interaction_stats(spark, folder):
    return catalog.interaction_stats(bed.loans(spark, folder))


@query(
    "user_stats",
    statement(
        "loans",
        """SELECT u, count(*) AS total_borrows, count(DISTINCT i) AS unique_books, min(t) AS first_borrow,
                  max(t) AS last_borrow FROM loans GROUP BY u""",
    ),
)
def user_stats(spark, folder):
    return catalog.user_stats(bed.loans(spark, folder))


@query(
    "user_history",
    statement(
        "loans items",
        """SELECT u, i, count(*) AS times_borrowed, any_value("Title") AS title, any_value("Author") AS author
           FROM loans LEFT JOIN items USING (i) GROUP BY u, i""",
    ),
)
def user_history(spark, folder):
    history = catalog.user_history(bed.loans(spark, folder), bed.items(spark, folder))
    return history.select("u", "i", "times_borrowed", F.col("Title").alias("title"), F.col("Author").alias("author"))


@query(
    "item_popularity_top",
    statement("loans", "SELECT i, count(*) AS borrow_count FROM loans GROUP BY i ORDER BY 2 DESC, 1 LIMIT 20"),
)
def item_popularity_top(spark, folder):
    return catalog.top_items(bed.loans(spark, folder), 20)


@query(
    "overview_kpis",
    statement(
        "loans items",
        """SELECT count(DISTINCT u) AS total_users, (SELECT count(*) FROM items) AS total_books,
                  count(*) AS total_borrows, round(count(*) / count(DISTINCT u), 1) AS borrows_per_user FROM loans""",
    ),
)
def overview_kpis(spark, folder):
    return catalog.overview_kpis(bed.loans(spark, folder), bed.items(spark, folder))


@query(
    "user_kpis",
    statement(
        "loans",
        """SELECT u, count(*) AS total_borrows, count(DISTINCT i) AS unique_books,
                  round(count(*) / count(DISTINCT i), 1) AS borrows_per_book FROM loans GROUP BY u""",
    ),
)
def user_kpis(spark, folder):
    return catalog.user_kpis(bed.loans(spark, folder))


@query(
    "item_stats",
    statement(
        "loans items clean",
        """SELECT count(*) AS n_items,
                  CAST(round(avg(CASE WHEN len(subjects_list) > 0 THEN 100.0 ELSE 0 END), 2) AS VARCHAR) || '%'
                      AS n_items_with_subjects,
                  CAST(round(avg(CASE WHEN author_clean <> '__UNKNOWN__' THEN 100.0 ELSE 0 END), 2) AS VARCHAR) || '%'
                      AS n_items_with_authors,
                  CAST(round(avg(CASE WHEN publisher_clean <> '__UNKNOWN__' THEN 100.0 ELSE 0 END), 2) AS VARCHAR) || '%'
                      AS n_items_with_publishers
           FROM clean""",
    ),
)
def item_stats(spark, folder):
    return catalog.item_stats(catalog.clean_items(bed.items(spark, folder), bed.loans(spark, folder)))


@query(
    "metadata_coverage",
    statement(
        "items",
        " UNION ALL ".join(
            f"""SELECT '{f}' AS field, count("{f}") AS n_filled, count(DISTINCT "{f}") AS n_distinct,
                       round(count("{f}") * 100.0 / count(*), 2) AS filled_pct FROM items"""
            for f in ("Title", "Author", "Publisher", "Subjects")
        ),
    ),
)
def metadata_coverage(spark, folder):
    return catalog.metadata_coverage(bed.items(spark, folder))


@query(
    "orphan_check",
    statement("loans items", "SELECT count(*) AS n_orphans FROM loans WHERE i NOT IN (SELECT i FROM items)"),
)
def orphan_check(spark, folder):
    return catalog.orphan_loans(bed.loans(spark, folder), bed.items(spark, folder))


@query(
    "sparsity",
    statement(
        "loans ratings",
        """SELECT CAST(sum(r) AS BIGINT) AS n_interactions, count(*) AS n_pairs,
                  count(*) FILTER (r > 1) AS repeat_pairs, CAST(sum(r - 1) AS BIGINT) AS repeat_interactions,
                  count(DISTINCT u) AS n_users, count(DISTINCT i) AS n_items,
                  round((1 - sum(r) / (count(DISTINCT u) * count(DISTINCT i))) * 100, 4) AS sparsity_pct,
                  round((1 - count(*) / (count(DISTINCT u) * count(DISTINCT i))) * 100, 4) AS pair_sparsity_pct
           FROM ratings""",
    ),
)
def sparsity(spark, folder):
    return catalog.sparsity(bed.loans(spark, folder))


def _buckets(value: str, uppers: list[int], source: str) -> str:
    cases, low = "", 1
    for upper in uppers:
        name = str(upper) if low == upper else f"{low}-{upper}"
        cases += f" WHEN n <= {upper} THEN '{name}'"
        low = upper + 1
    return f"""SELECT bucket, count(*) AS n_keys, round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS pct
               FROM (SELECT CASE{cases} ELSE '{low}+' END AS bucket FROM (SELECT {value} AS n FROM {source}))
               GROUP BY bucket"""


@query("user_activity_buckets", statement("loans", _buckets("count(*)", [2, 5, 10, 20, 50], "loans GROUP BY u")))
def user_activity_buckets(spark, folder):
    return catalog.activity_buckets(bed.loans(spark, folder), "u", [2, 5, 10, 20, 50])


@query("item_popularity_buckets", statement("loans", _buckets("count(*)", [1, 5, 10, 20], "loans GROUP BY i")))
def item_popularity_buckets(spark, folder):
    return catalog.activity_buckets(bed.loans(spark, folder), "i", [1, 5, 10, 20])


@query(
    "subjects_per_item_buckets",
    statement("loans items clean", _buckets("len(subjects_list)", [1, 3, 6], "clean WHERE len(subjects_list) > 0")),
)
def subjects_per_item_buckets(spark, folder):
    cleaned = catalog.clean_items(bed.items(spark, folder), bed.loans(spark, folder))
    return catalog.subjects_per_item_buckets(cleaned, [1, 3, 6])


@query(
    "top_subjects",
    statement(
        "loans items clean tags", "SELECT subject, count(*) AS n FROM tags GROUP BY subject ORDER BY n DESC, subject LIMIT 15"
    ),
)
def top_subjects(spark, folder):
    return catalog.top_subjects(catalog.clean_items(bed.items(spark, folder), bed.loans(spark, folder)))


@query(
    "subjects_near_cutoff",
    statement(
        "loans items clean tags counts",
        """SELECT subject, n, n >= 5 AS in_vocab FROM (
               (SELECT * FROM counts WHERE n >= 5 ORDER BY n, subject DESC LIMIT 3)
               UNION ALL (SELECT * FROM counts WHERE n < 5 ORDER BY n DESC, subject LIMIT 3))""",
        {"counts": "SELECT subject, count(*) AS n FROM tags GROUP BY subject"},
    ),
)
def subjects_near_cutoff(spark, folder):
    return catalog.subjects_near_cutoff(catalog.clean_items(bed.items(spark, folder), bed.loans(spark, folder)), 5)


@query(
    "data_profile",
    statement(
        "loans items",
        """SELECT 'loans' AS table_name, CAST(3 AS INT) AS n_columns, 'u,i,t' AS columns, count(*) AS n_rows,
                  min(u) AS min_key, max(u) AS max_key FROM loans
           UNION ALL SELECT 'items', 6, 'Title,Author,ISBN Valid,Publisher,Subjects,i', count(*), min(i), max(i)
           FROM items""",
    ),
)
def data_profile(spark, folder):
    loans = catalog.data_profile(bed.loans(spark, folder), "loans", "u")
    return loans.unionByName(catalog.data_profile(bed.items(spark, folder), "items", "i"))


@query(
    "cold_start_report",
    statement(
        "loans items",
        """SELECT count(*) AS n_items, count(*) FILTER (i NOT IN (SELECT i FROM loans)) AS n_removed,
                  round(count(*) FILTER (i NOT IN (SELECT i FROM loans)) * 100.0 / count(*), 1) AS removed_pct
           FROM items""",
    ),
)
def cold_start_report(spark, folder):
    return catalog.cold_start_report(bed.items(spark, folder), bed.loans(spark, folder))


@query(
    "items_semi_interacted",
    statement("loans items", 'SELECT i, "Title" AS title FROM items WHERE i IN (SELECT i FROM loans)'),
)
def items_semi_interacted(spark, folder):
    kept = catalog.interacted_items(bed.items(spark, folder), bed.loans(spark, folder))
    return kept.select("i", F.col("Title").alias("title"))


@query("known_item_interactions", statement("loans items", "SELECT u, i, t FROM loans WHERE i IN (SELECT i FROM items)"))
def known_item_interactions(spark, folder):
    return catalog.known_items(bed.loans(spark, folder), bed.items(spark, folder)).select("u", "i", "t")


_COUNTED = {
    "listing": """SELECT items.*, coalesce(n, 0) AS borrow_count
                  FROM items LEFT JOIN (SELECT i, count(*) AS n FROM loans GROUP BY i) USING (i)"""
}


@query(
    "catalog_with_counts",
    statement("loans items listing", 'SELECT i, "Title" AS title, borrow_count FROM listing', _COUNTED),
)
def catalog_with_counts(spark, folder):
    listing = catalog.items_with_counts(bed.items(spark, folder), bed.loans(spark, folder))
    return listing.select("i", F.col("Title").alias("title"), "borrow_count")


@query(
    "catalog_search_sorted_page",
    statement(
        "loans items listing found",
        """SELECT i, "Title" AS title, "Author" AS author, borrow_count FROM found ORDER BY borrow_count DESC, i
           LIMIT 20 OFFSET (SELECT least(1, greatest(1, CAST(ceil(count(*) / 20) AS BIGINT)) - 1) * 20 FROM found)""",
        {
            **_COUNTED,
            "found": """SELECT * FROM listing WHERE regexp_matches(lower("Title"), 'red|blue.*bolt')
                        AND regexp_matches(lower("Author"), 'brand#1')""",
        },
    ),
)
def catalog_search_sorted_page(spark, folder):
    found = catalog.search_items(bed.items(spark, folder), title="Red|Blue.*bolt", author="brand#1")
    listing = catalog.sort_items(catalog.items_with_counts(found, bed.loans(spark, folder)))
    page = catalog.page_of(listing, 1, 20)
    return page.select("i", F.col("Title").alias("title"), F.col("Author").alias("author"), "borrow_count")


@query(
    "catalog_author_page",
    statement(
        "loans items listing",
        """SELECT i, "Author" AS author, borrow_count FROM listing ORDER BY "Author" ASC NULLS LAST, i LIMIT 40""",
        _COUNTED,
    ),
)
def catalog_author_page(spark, folder):
    listing = catalog.items_with_counts(bed.items(spark, folder), bed.loans(spark, folder))
    page = catalog.page_of(catalog.sort_items(listing, "Author"), 0, 40)
    return page.select("i", F.col("Author").alias("author"), "borrow_count")


@query(
    "catalog_last_page",
    statement(
        "loans items listing total",
        """SELECT i, "Title" AS title FROM listing ORDER BY "Title" ASC NULLS LAST, i
           LIMIT 40 OFFSET (SELECT (greatest(1, CAST(ceil(n / 40) AS BIGINT)) - 1) * 40 FROM total)""",
        {**_COUNTED, "total": "SELECT count(*) AS n FROM listing"},
    ),
)
def catalog_last_page(spark, folder):
    listing = catalog.items_with_counts(bed.items(spark, folder), bed.loans(spark, folder))
    return catalog.page_of(catalog.sort_items(listing, "Title"), 10**9, 40).select("i", F.col("Title").alias("title"))


@query(
    "catalog_page_summary",
    statement(
        "items",
        """SELECT count(*) AS total_rows, greatest(1, CAST(ceil(count(*) / 20) AS BIGINT)) AS total_pages,
                  greatest(1, CAST(ceil(count(*) / 20) AS BIGINT)) - 1 AS page FROM items""",
    ),
)
def catalog_page_summary(spark, folder):
    return catalog.page_summary(bed.items(spark, folder), 10**9, 20)


@query(
    "catalog_keyset_page",
    statement(
        "loans items listing",
        """SELECT i, borrow_count FROM listing WHERE borrow_count < 30 OR (borrow_count = 30 AND i > 100)
           ORDER BY borrow_count DESC, i LIMIT 20""",
        _COUNTED,
    ),
)
def catalog_keyset_page(spark, folder):
    listing = catalog.items_with_counts(bed.items(spark, folder), bed.loans(spark, folder))
    return catalog.page_after(listing, "borrow_count", 30, 100, 20).select("i", "borrow_count")


@query(
    "user_search",
    statement(
        "loans",
        """SELECT u, count(*) AS total_borrows, count(DISTINCT i) AS unique_books FROM loans
           WHERE regexp_matches(CAST(u AS VARCHAR), '1.2') GROUP BY u""",
    ),
)
def user_search(spark, folder):
    return catalog.search_users(catalog.user_stats(bed.loans(spark, folder)), "1.2").select(
        "u", "total_borrows", "unique_books"
    )


@query(
    "user_sorted_page",
    statement(
        "loans",
        """SELECT u, count(*) AS total_borrows, count(DISTINCT i) AS unique_books FROM loans GROUP BY u
           ORDER BY unique_books DESC, u LIMIT 24 OFFSET 24""",
    ),
)
def user_sorted_page(spark, folder):
    stats = catalog.user_stats(bed.loans(spark, folder)).select("u", "total_borrows", "unique_books")
    return catalog.page_of(catalog.sort_users(stats, "unique_books"), 1, 24)


@query("random_items")
def random_items(spark, folder):
    return cut_lineage(catalog.sample_items(bed.items(spark, folder), 10)).select("i", F.col("Title").alias("title"))
