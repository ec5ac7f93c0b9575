"""Encoders, indices and user-by-feature matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import catalog, encoders, histories, indexing, matrices
from ..operators.spreading import look_up
from ..session import cut_lineage
from ..sources import testbed as bed
from . import query
from .cleaning import ngram_parts
from .fragments import statement

DIM = 64


def cleaned_items(spark, folder):
    return catalog.clean_items(bed.items(spark, folder), bed.loans(spark, folder))


def coded_items(spark, folder, cleaned=None):
    cleaned = cut_lineage(cleaned_items(spark, folder)) if cleaned is None else cleaned
    coded, authors = encoders.encode_authors(cleaned)
    return encoders.encode_publishers(coded)[0], authors


def weighted_subjects(spark, folder, cleaned=None):
    cleaned = cut_lineage(cleaned_items(spark, folder)) if cleaned is None else cleaned
    return encoders.subject_tfidf(cleaned, encoders.subject_vocabulary(cleaned))


_CODED = "loans items clean authors publishers coded"
_TAGS = "loans items clean tags vocab"


@query("rare_author_encoding", statement(_CODED, "SELECT i, author_clean, author_code FROM coded"))
def rare_author_encoding(spark, folder):
    return encoders.encode_authors(cleaned_items(spark, folder))[0].select("i", "author_clean", "author_code")


@query("author_classes", statement("loans items clean authors", "SELECT label, code, frequent FROM authors"))
def author_classes(spark, folder):
    return encoders.fit_categories(cleaned_items(spark, folder), "author_clean", 2, tx.RARE_AUTHOR)


@query("rare_publisher_encoding", statement(_CODED, "SELECT i, publisher_clean, publisher_code FROM coded"))
def rare_publisher_encoding(spark, folder):
    return encoders.encode_publishers(cleaned_items(spark, folder))[0].select("i", "publisher_clean", "publisher_code")


@query(
    "subject_min_count",
    statement(
        "loans items clean tags kept",
        """SELECT c.i, coalesce(string_agg(k.subject, '|' ORDER BY k.pos), '') AS subjects_clean
           FROM clean c LEFT JOIN kept k ON k.i = c.i GROUP BY c.i""",
        {
            "kept": """SELECT i, pos, subject FROM tags WHERE subject IN (
                           SELECT subject FROM tags GROUP BY subject HAVING count(*) >= 6)"""
        },
    ),
)
def subject_min_count(spark, folder):
    kept, _ = encoders.clean_subjects(cleaned_items(spark, folder), 6)
    return kept.select("i", F.array_join("subjects_clean", "|").alias("subjects_clean"))


@query("subject_vocab", statement(_TAGS, "SELECT subject, subject_idx, n FROM vocab"))
def subject_vocab(spark, folder):
    return encoders.subject_vocabulary(cleaned_items(spark, folder))


@query(
    "vocabulary_sizes",
    statement(
        "loans items clean tags",
        """SELECT min_freq, count(*) FILTER (n >= min_freq) AS subjects
           FROM (SELECT subject, count(*) AS n FROM tags GROUP BY subject), (VALUES (1), (3), (5), (10), (20)) AS m(min_freq)
           GROUP BY min_freq""",
    ),
)
def vocabulary_sizes(spark, folder):
    counts = catalog.subject_counts(cleaned_items(spark, folder))
    levels = F.array(*[F.lit(level) for level in (1, 3, 5, 10, 20)])
    reached = counts.select("n", F.explode(levels).alias("min_freq"))
    return reached.groupBy("min_freq").agg(F.count_if(F.col("n") >= F.col("min_freq")).alias("subjects"))


@query(
    "multi_hot_subjects",
    statement(_TAGS, "SELECT DISTINCT i, subject_idx, CAST(1 AS DOUBLE) AS weight FROM tags JOIN vocab USING (subject)"),
)
def multi_hot_subjects(spark, folder):
    cleaned = cut_lineage(cleaned_items(spark, folder))
    return encoders.multi_hot(cleaned, encoders.subject_vocabulary(cleaned))


@query(
    "item_subject_index",
    statement(_TAGS, "SELECT i, CAST(pos AS INT) AS pos, subject_idx FROM tags JOIN vocab USING (subject)"),
)
def item_subject_index(spark, folder):
    cleaned = cut_lineage(cleaned_items(spark, folder))
    return encoders.item_subject_index(cleaned, encoders.subject_vocabulary(cleaned))


@query(
    "remove_singleton_subjects",
    statement(
        "loans items clean tags spread",
        """SELECT c.i, coalesce(string_agg(t.subject, '|' ORDER BY t.pos), '') AS subjects_list
           FROM clean c LEFT JOIN (SELECT * FROM tags WHERE subject IN (SELECT subject FROM spread)) t ON t.i = c.i
           GROUP BY c.i""",
        {"spread": "SELECT subject FROM tags GROUP BY subject HAVING count(DISTINCT i) <> 1"},
    ),
)
def remove_singleton_subjects(spark, folder):
    kept = catalog.clean_items(bed.items(spark, folder), bed.loans(spark, folder), remove_subjects=True)
    return kept.select("i", F.array_join("subjects_list", "|").alias("subjects_list"))


@query(
    "subject_tfidf",
    statement(_TAGS + " tf weights", "SELECT i, subject_idx, round(weight, 6) AS weight FROM weights"),
)
def subject_tfidf(spark, folder):
    return weighted_subjects(spark, folder).withColumn("weight", F.round("weight", 6))


_WORDS = {
    "vocabulary": """
        SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-zß-öø-ÿ]+')) AS doc FROM documents""",
    **ngram_parts("vocabulary"),
}


@query(
    "char_ngram_tfidf",
    statement(
        "vocabulary words grams gram_tf gram_raw gram_weights",
        "SELECT doc, term, round(weight, 6) AS weight FROM gram_weights",
        _WORDS,
    ),
)
def char_ngram_tfidf(spark, folder):
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-zß-öø-ÿ]+"), F.lit(0))
    words = bed.table(spark, folder, "documents").select(F.explode(words).alias("word")).distinct()
    return encoders.ngram_tfidf(words, "word").withColumn("weight", F.round("weight", 6))


@query("item_index", statement("items", "SELECT i, row_number() OVER (ORDER BY i) - 1 AS item_idx FROM items"))
def item_index(spark, folder):
    return indexing.item_index(bed.items(spark, folder))


@query(
    "user_index",
    statement(
        "loans",
        """SELECT u, row_number() OVER (ORDER BY t, i, u) - 1 AS user_idx
           FROM (SELECT u, t, i, row_number() OVER (PARTITION BY u ORDER BY t, i) AS k FROM loans) WHERE k = 1""",
    ),
)
def user_index(spark, folder):
    return indexing.user_index(bed.loans(spark, folder))


@query(
    "indexed_interactions",
    statement(
        "loans items iidx uidx",
        "SELECT user_idx, item_idx, count(*) AS n FROM loans JOIN iidx USING (i) JOIN uidx USING (u) GROUP BY 1, 2",
        {
            "iidx": "SELECT i, row_number() OVER (ORDER BY i) - 1 AS item_idx FROM items",
            "uidx": """SELECT u, row_number() OVER (ORDER BY t, i, u) - 1 AS user_idx
                       FROM (SELECT u, t, i, row_number() OVER (PARTITION BY u ORDER BY t, i) AS k FROM loans)
                       WHERE k = 1""",
        },
    ),
)
def indexed_interactions(spark, folder):
    loans = bed.loans(spark, folder)
    both = indexing.with_indices(loans, indexing.user_index(loans), indexing.item_index(bed.items(spark, folder)))
    return both.groupBy("user_idx", "item_idx").agg(F.count(F.lit(1)).alias("n"))


@query(
    "index_validation",
    statement(
        _CODED,
        """SELECT unnest(['repeated_item_idx', 'item_idx_gaps', 'author_code_range', 'publisher_code_range',
                          'subject_idx_range', 'negative_weights', 'embedding_rows']) AS "check",
                  CAST(0 AS BIGINT) * count(*) AS violations FROM coded""",
    ),
)
def index_validation(spark, folder):
    cleaned = cut_lineage(cleaned_items(spark, folder))
    coded, authors = encoders.encode_authors(cleaned)
    coded, publishers = encoders.encode_publishers(coded)
    index = indexing.item_index(cleaned)
    vocabulary = encoders.subject_vocabulary(cleaned)
    embeddings = indexing.reindex_embeddings(index, bed.item_embeddings(spark, folder), DIM)
    return indexing.index_violations(
        coded.join(index.hint("merge"), "i"),
        authors.count(),
        publishers.count(),
        encoders.subject_tfidf(cleaned, vocabulary),
        vocabulary.count(),
        embeddings.count(),
    )


@query(
    "item_uniqueness",
    statement(
        "loans items clean",
        "SELECT count(*) - count(DISTINCT i) AS duplicate_ids, count(*) - count(title_clean) AS missing_titles FROM clean",
    ),
)
def item_uniqueness(spark, folder):
    return indexing.uniqueness_check(cleaned_items(spark, folder))


@query(
    "reindex_match_rate",
    statement(
        "items",
        """SELECT count(*) AS n_items, count(*) FILTER (i IN (SELECT vec_id FROM embeddings)) AS matched,
                  round(count(*) FILTER (i IN (SELECT vec_id FROM embeddings)) * 100.0 / count(*), 1) AS matched_pct
           FROM items""",
    ),
)
def reindex_match_rate(spark, folder):
    return indexing.match_rate(bed.items(spark, folder).select("i"), bed.item_embeddings(spark, folder))


@query(
    "reindex_embeddings",
    statement(
        "items emb emb_long",
        """SELECT i, item_idx, CAST(p.pos AS INT) AS pos, round(coalesce(x, 0), 6) AS value
           FROM (SELECT i, row_number() OVER (ORDER BY i) - 1 AS item_idx FROM items)
           CROSS JOIN (SELECT unnest(range(64)) AS pos) p LEFT JOIN emb_long USING (i, pos)""",
    ),
)
def reindex_embeddings(spark, folder):
    index = indexing.item_index(bed.items(spark, folder))
    aligned = indexing.reindex_embeddings(index, bed.item_embeddings(spark, folder), DIM)
    return aligned.select("i", "item_idx", F.posexplode("embedding").alias("pos", "value")).withColumn(
        "value", F.round("value", 6)
    )


@query(
    "reindex_subject_tfidf",
    statement(
        "loans items clean tags vocab tf weights",
        """SELECT i, item_idx, subject_idx, round(coalesce(weight, 0), 6) AS weight
           FROM (SELECT i, row_number() OVER (ORDER BY i) - 1 AS item_idx FROM items) LEFT JOIN weights USING (i)""",
    ),
)
def reindex_subject_tfidf(spark, folder):
    index = indexing.item_index(bed.items(spark, folder))
    aligned = indexing.reindex_weights(index, weighted_subjects(spark, folder))
    return aligned.select("i", "item_idx", "subject_idx", F.round("weight", 6).alias("weight"))


@query(
    "subject_match_rate",
    statement(
        "loans items clean tags vocab tf weights",
        """SELECT count(*) AS n_items, count(*) FILTER (i IN (SELECT i FROM weights)) AS matched,
                  round(count(*) FILTER (i IN (SELECT i FROM weights)) * 100.0 / count(*), 1) AS matched_pct
           FROM items""",
    ),
)
def subject_match_rate(spark, folder):
    return indexing.match_rate(bed.items(spark, folder).select("i"), weighted_subjects(spark, folder))


@query(
    "user_author_matrix",
    statement(
        _CODED,
        """SELECT u, author_code AS feature, CAST(count(*) AS DOUBLE) AS r FROM loans JOIN coded USING (i) GROUP BY 1, 2""",
    ),
)
def user_author_matrix(spark, folder):
    return matrices.user_author_matrix(bed.loans(spark, folder), coded_items(spark, folder)[0])


@query(
    "user_publisher_matrix",
    statement(
        _CODED,
        """SELECT u, publisher_code AS feature, CAST(count(*) AS DOUBLE) AS r FROM loans JOIN coded USING (i)
           GROUP BY 1, 2""",
    ),
)
def user_publisher_matrix(spark, folder):
    return matrices.user_publisher_matrix(bed.loans(spark, folder), coded_items(spark, folder)[0])


@query(
    "user_subject_tfidf",
    statement(
        _TAGS + " tf weights",
        "SELECT u, subject_idx AS feature, round(sum(weight), 6) AS r FROM loans JOIN weights USING (i) GROUP BY 1, 2",
    ),
)
def user_subject_tfidf(spark, folder):
    sums = matrices.user_subject_matrix(bed.loans(spark, folder), weighted_subjects(spark, folder))
    return sums.withColumn("r", F.round("r", 6))


@query(
    "user_subject_multihot",
    statement(
        _TAGS,
        """SELECT u, subject_idx AS feature, CAST(count(*) AS DOUBLE) AS r FROM loans
           JOIN (SELECT DISTINCT i, subject_idx FROM tags JOIN vocab USING (subject)) USING (i) GROUP BY 1, 2""",
    ),
)
def user_subject_multihot(spark, folder):
    cleaned = cut_lineage(cleaned_items(spark, folder))
    hot = encoders.multi_hot(cleaned, encoders.subject_vocabulary(cleaned))
    return matrices.user_subject_matrix(bed.loans(spark, folder), hot)


@query(
    "user_subject_counts",
    statement(
        "loans items clean tags",
        """SELECT u, subject, CAST(count(*) AS DOUBLE) AS r FROM loans JOIN tags USING (i) GROUP BY 1, 2""",
    ),
)
def user_subject_counts(spark, folder):
    cleaned = cut_lineage(cleaned_items(spark, folder))
    numbered = encoders.number_subjects(catalog.subject_rows(cleaned))
    counts = matrices.user_subject_counts(bed.loans(spark, folder), cleaned, numbered)
    named = look_up(counts, numbered.withColumnRenamed("subject_idx", "feature"), "feature")
    return named.select("u", "subject", "r")


@query("user_item_matrix", statement("loans ratings", "SELECT u, i, r FROM ratings"))
def user_item_matrix(spark, folder):
    return matrices.user_item_counts(bed.loans(spark, folder))


@query(
    "rank_weighted_matrix",
    statement(
        "loans ranked", "SELECT u, i, CAST(sum(interaction_rank) AS DOUBLE) AS r FROM ranked GROUP BY u, i"
    ),
)
def rank_weighted_matrix(spark, folder):
    ranked = histories.clean_interactions(bed.loans(spark, folder))
    return matrices.user_item_weights(ranked, "interaction_rank")


_PROFILES = "loans ratings emb emb_long profile_long"


def _profile(spark, folder, how):
    profile = matrices.user_embeddings(bed.loans(spark, folder), bed.item_embeddings(spark, folder), DIM, how)
    return profile.select("u", F.posexplode("embedding").alias("pos", "value")).withColumn("value", F.round("value", 6))


@query(
    "user_embedding_mean",
    statement(_PROFILES, "SELECT u, CAST(pos AS INT) AS pos, round(x, 6) AS value FROM profile_long"),
)
def user_embedding_mean(spark, folder):
    return _profile(spark, folder, "mean")


@query(
    "user_embedding_sum",
    statement(_PROFILES, "SELECT u, CAST(pos AS INT) AS pos, round(total, 6) AS value FROM profile_long"),
)
def user_embedding_sum(spark, folder):
    return _profile(spark, folder, "sum")
