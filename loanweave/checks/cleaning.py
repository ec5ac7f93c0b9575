"""Text cleaning, display fields, covers and canonical subjects."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import catalog, covers
from ..operators import subjects as sb
from ..plans.canonicalise import canonicalise
from ..session import cut_lineage
from ..sources import testbed as bed
from . import query
from .fragments import statement


def _joined(column: str):
    return F.array_join(column, "|").alias(column)


@query(
    "clean_title_author_publisher",
    statement("loans items clean", "SELECT i, title_clean, author_clean, publisher_clean FROM clean"),
)
def clean_title_author_publisher(spark, folder):
    cleaned = catalog.clean_items(bed.items(spark, folder), bed.loans(spark, folder))
    return cleaned.select("i", "title_clean", "author_clean", "publisher_clean")


@query(
    "parse_subjects",
    statement(
        "loans items clean",
        """SELECT i, array_to_string(subjects_list, '|') AS subjects_list, len(subjects_list) > 0 AS has_subjects
           FROM clean""",
    ),
)
def parse_subjects(spark, folder):
    cleaned = catalog.clean_items(bed.items(spark, folder), bed.loans(spark, folder))
    return cleaned.select("i", _joined("subjects_list"), "has_subjects")


_TWO_AUTHORS = {
    "two": """
        SELECT i, CASE WHEN i % 5 = 0 THEN "Author" || ' & ' || split_part("Author", ',', 1) || ', Ann, 1950-'
                                           || ' ; ' || "Author" ELSE "Author" END AS a FROM items""",
    "names": """
        SELECT i, a, list_filter(list_transform(list_transform(regexp_split_to_array(a, '[;&]'),
                   lambda x: regexp_replace(trim(x), ',?\\s*\\d{4}-?', '', 'g')),
                   lambda x: trim(regexp_replace(CASE WHEN contains(x, ',')
                        THEN trim(substr(x, strpos(x, ',') + 1)) || ' ' || trim(split_part(x, ',', 1)) ELSE x END,
                        '\\s+', ' ', 'g'))), lambda x: x <> '') AS l FROM two""",
}


@query(
    "canonical_authors",
    statement(
        "items two names",
        """SELECT i, CASE WHEN a IS NOT NULL THEN array_to_string(list_transform(list_filter(
                      list_zip(l, generate_series(1, len(l))), lambda z: list_position(l, z[1]) = z[2]),
                      lambda z: z[1]), '; ') END AS author FROM names""",
        _TWO_AUTHORS,
    ),
)
def canonical_authors(spark, folder):
    items = bed.items_with_second_author(spark, folder)
    return items.select("i", tx.author_names(F.col("Author")).alias("author"))


_NORMAL = {
    "exploded": """
        SELECT i, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(s)), '--|/|,', ' ', 'g'),
                   '\\b\\d{4}(-\\d{4})?\\b', '', 'g'), '[^\\w\\s]', '', 'g'), '\\s+', ' ', 'g')) AS subject
        FROM (SELECT i, unnest(string_split("Subjects", ';')) AS s FROM items)""",
    "fine": "SELECT * FROM exploded WHERE subject <> ''",
}


@query("normalize_subject", statement("items exploded fine", "SELECT i, subject FROM fine", _NORMAL))
def normalize_subject(spark, folder):
    return sb.exploded_subjects(bed.items(spark, folder))


@query(
    "subject_frequencies",
    statement(
        "items exploded fine",
        "SELECT subject, count(*) AS n, count(*) >= 2 AS frequent FROM fine GROUP BY subject",
        _NORMAL,
    ),
)
def subject_frequencies(spark, folder):
    return sb.subject_frequencies(sb.exploded_subjects(bed.items(spark, folder)))


@query(
    "isbn_candidates",
    statement(
        "items",
        """SELECT i, '978' || lpad(CAST(i AS VARCHAR), 10, '0') || '|' || lpad(CAST(i AS VARCHAR), 9, '0') || 'X' AS isbns
           FROM items""",
    ),
)
def isbn_candidates(spark, folder):
    return bed.items(spark, folder).select("i", F.array_join(tx.isbn_list(F.col("ISBN Valid")), "|").alias("isbns"))


_COVERS = {
    "covers": """
        SELECT item_id, isbn, 'https://covers.example/' || isbn || '-' || size || '-v' || seq AS cover_url, size, seq
        FROM (SELECT p_partkey AS item_id, '978' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS isbn, size, seq
              FROM part JOIN (VALUES ('S', 0, 20), ('M', 0, 20), ('M', 1, 10)) AS v(size, seq, top) ON p_size <= top)""",
    "cache": """
        SELECT item_id, size, arg_max(isbn, seq) AS isbn, arg_max(cover_url, seq) AS cover_url FROM covers
        GROUP BY item_id, size""",
    "updates": """
        SELECT p_partkey AS item_id, 'M' AS size, '979' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS isbn,
               'https://covers.example/979' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') || '-M-v9' AS cover_url
        FROM part WHERE p_size > 15""",
}


@query(
    "cover_urls",
    statement(
        "items covers cache",
        """SELECT i, coalesce(cover_url || '|', '') || 'https://covers.openlibrary.org/b/isbn/978'
                     || lpad(CAST(i AS VARCHAR), 10, '0') || '-M.jpg|https://covers.openlibrary.org/b/isbn/'
                     || lpad(CAST(i AS VARCHAR), 9, '0') || 'X-M.jpg|data:,no-cover' AS cover_urls,
                  coalesce(cover_url, 'https://covers.openlibrary.org/b/isbn/978' || lpad(CAST(i AS VARCHAR), 10, '0')
                     || '-M.jpg') AS primary_url
           FROM items LEFT JOIN cache ON item_id = i AND size = 'M'""",
        _COVERS,
    ),
)
def cover_urls(spark, folder):
    found = covers.cover_urls(bed.items(spark, folder), covers.latest_rows(bed.covers(spark, folder)))
    return found.select("i", _joined("cover_urls"), "primary_url")


@query("cover_cache_latest", statement("covers cache", "SELECT item_id, size, isbn, cover_url FROM cache", _COVERS))
def cover_cache_latest(spark, folder):
    return covers.latest_rows(bed.covers(spark, folder))


@query(
    "cover_cache_upsert",
    statement(
        "covers cache updates",
        """SELECT item_id, size, isbn, cover_url FROM updates UNION ALL
           SELECT item_id, size, isbn, cover_url FROM cache c
           WHERE NOT EXISTS (SELECT 1 FROM updates u WHERE u.item_id = c.item_id AND u.size = c.size)""",
        _COVERS,
    ),
)
def cover_cache_upsert(spark, folder):
    updates = covers.latest_rows(bed.cover_updates(spark, folder))
    return covers.upsert(covers.latest_rows(bed.covers(spark, folder)), updates)


@query(
    "cover_cache_map",
    statement(
        "covers cache",
        """SELECT item_id, max(cover_url) FILTER (size = 'S') AS small, max(cover_url) FILTER (size = 'M') AS medium
           FROM cache GROUP BY item_id""",
        _COVERS,
    ),
)
def cover_cache_map(spark, folder):
    mapped = covers.cover_map(covers.latest_rows(bed.covers(spark, folder)))
    return mapped.select("item_id", F.col("covers")["S"].alias("small"), F.col("covers")["M"].alias("medium"))


@query(
    "cover_cache_coverage",
    statement(
        "items covers",
        """SELECT count(*) FILTER (i IN (SELECT item_id FROM covers)) AS cached_items, count(*) AS n_items,
                  round(count(*) FILTER (i IN (SELECT item_id FROM covers)) * 100.0 / count(*), 1) AS cached_pct
           FROM items""",
        _COVERS,
    ),
)
def cover_cache_coverage(spark, folder):
    return covers.coverage(bed.items(spark, folder), bed.covers(spark, folder))


@query(
    "cover_cache_refresh",
    statement(
        "items covers",
        """SELECT i AS item_id, 'M' AS size, CASE WHEN p_size > 40 THEN lpad(CAST(i AS VARCHAR), 9, '0') || 'X'
                      ELSE '978' || lpad(CAST(i AS VARCHAR), 10, '0') END AS isbn,
                  'https://covers.openlibrary.org/b/isbn/' || CASE WHEN p_size > 40
                      THEN lpad(CAST(i AS VARCHAR), 9, '0') || 'X'
                      ELSE '978' || lpad(CAST(i AS VARCHAR), 10, '0') END || '-M.jpg' AS cover_url
           FROM items JOIN part ON p_partkey = i WHERE i NOT IN (SELECT item_id FROM covers WHERE size = 'M')""",
        _COVERS,
    ),
)
def cover_cache_refresh(spark, folder):
    items = bed.items(spark, folder)
    sized = items.join(bed.table(spark, folder, "part").select(F.col("p_partkey").alias("i"), "p_size"), "i")
    codes = tx.isbn_list(F.col("ISBN Valid"))
    alive = sized.select(F.explode(F.when(F.col("p_size") > 40, F.slice(codes, 2, 1)).otherwise(codes)).alias("isbn"))
    verified = alive.select(F.format_string(tx.COVER_URL, "isbn", F.lit("M")).alias("cover_url"))
    return covers.refresh(items, bed.covers(spark, folder), verified)


@query(
    "display_projection",
    statement(
        "items",
        """SELECT i, CASE WHEN length("Title") > 12 THEN substr("Title", 1, 12) || '...' ELSE "Title" END AS title,
                  coalesce("Author", 'Unknown Author') AS author, coalesce("Publisher", 'Unknown Publisher') AS publisher,
                  coalesce(array_to_string(list_transform(string_split("Subjects", ';')[1:3], lambda x: trim(x)), '|'), '')
                      AS badges,
                  'https://covers.openlibrary.org/b/isbn/978' || lpad(CAST(i AS VARCHAR), 10, '0') || '-S.jpg' AS cover
           FROM items""",
    ),
)
def display_projection(spark, folder):
    cards = catalog.display_cards(bed.items(spark, folder), 12, "S")
    return cards.select(
        "i", "title", "author", "publisher", _joined("badges"), F.element_at("cover_urls", 1).alias("cover")
    )


def ngram_parts(source: str, min_df: int = 2) -> dict[str, str]:
    """SQL for character n-gram weights of ``source(doc)``."""
    return {
        "words": f"SELECT doc, ' ' || unnest(string_split_regex(doc, '\\s+')) || ' ' AS w FROM {source}",
        "grams": """
            SELECT doc, substr(w, s, n) AS term FROM (
                SELECT doc, w, n, unnest(generate_series(1, length(w) - n + 1)) AS s
                FROM words, (VALUES (3), (4), (5)) AS sizes(n) WHERE length(w) >= n AND length(w) > 2)""",
        "gram_tf": "SELECT doc, term, count(*) AS tf FROM grams GROUP BY doc, term",
        "gram_raw": f"""
            SELECT doc, term, tf * (ln((1.0 + (SELECT count(*) FROM {source})) / (1.0 + df)) + 1.0) AS raw
            FROM (SELECT *, count(*) OVER (PARTITION BY term) AS df FROM gram_tf) WHERE df >= {min_df}""",
        "gram_weights": "SELECT doc, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc)) AS weight FROM gram_raw",
    }


_FREQUENT = {
    **_NORMAL,
    "freq": "SELECT subject, count(*) AS n FROM fine GROUP BY subject",
    "common": "SELECT subject AS doc, n FROM freq WHERE n >= 2",
}


@query(
    "subject_similarity_pairs",
    statement(
        "items exploded fine freq common words grams gram_tf gram_raw gram_weights",
        """SELECT a.doc AS subject_1, b.doc AS subject_2, round(sum(a.weight * b.weight), 6) AS similarity
           FROM gram_weights a JOIN gram_weights b ON a.term = b.term AND a.doc < b.doc
           GROUP BY 1, 2 HAVING round(sum(a.weight * b.weight), 9) > 0.75""",
        {**_FREQUENT, **ngram_parts("common")},
    ),
)
def subject_similarity_pairs(spark, folder):
    frequent = sb.subject_frequencies(sb.exploded_subjects(bed.items(spark, folder))).filter("frequent")
    numbered, vectors = sb.numbered_vectors(frequent)
    first = numbered.select(F.col("id").alias("id_1"), F.col("subject").alias("subject_1"))
    second = numbered.select(F.col("id").alias("id_2"), F.col("subject").alias("subject_2"))
    pairs = sb.similar_pairs(vectors).join(first, "id_1").join(second, "id_2")
    return pairs.select("subject_1", "subject_2", F.round("similarity", 6).alias("similarity"))


_ATTACHED = {
    **_FREQUENT,
    "texts": "SELECT subject AS doc, n FROM freq",
    **ngram_parts("texts"),
    "single_sims": """
        SELECT a.doc AS subject, b.doc AS parent, round(sum(a.weight * b.weight), 9) AS similarity
        FROM gram_weights a JOIN freq x ON x.subject = a.doc AND x.n = 1
        JOIN gram_weights b ON a.term = b.term JOIN freq y ON y.subject = b.doc AND y.n >= 2 GROUP BY 1, 2""",
    "best": """
        SELECT subject, parent, similarity FROM (
            SELECT *, row_number() OVER (PARTITION BY subject ORDER BY similarity DESC, parent) AS k FROM single_sims
            WHERE similarity >= 0.6) WHERE k = 1""",
}
_ATTACH_NAMES = "items exploded fine freq texts words grams gram_tf gram_raw gram_weights single_sims best"


@query(
    "attach_singletons",
    statement(
        _ATTACH_NAMES,
        """SELECT f.subject, parent, round(similarity, 6) AS similarity FROM freq f LEFT JOIN best USING (subject)
           WHERE f.n = 1""",
        _ATTACHED,
    ),
)
def attach_singletons(spark, folder):
    frequencies = cut_lineage(sb.subject_frequencies(sb.exploded_subjects(bed.items(spark, folder))))
    attached = sb.attach_by_ngrams(frequencies.filter("not frequent"), frequencies.filter("frequent"))
    return attached.withColumn("similarity", F.round("similarity", 6))


@query(
    "attach_by_embedding",
    statement(
        "emb emb_exact",
        """SELECT singles.i AS id, parent, similarity
           FROM (SELECT i FROM emb_exact JOIN embeddings ON vec_id = i AND label < 5) singles LEFT JOIN (
               SELECT s.i, arg_max(c.i, round(list_dot_product(s.e, c.e), 9) * 1e6 - c.i * 1e-9) AS parent,
                      round(max(list_dot_product(s.e, c.e)), 6) AS similarity
               FROM emb_exact s JOIN embeddings sl ON sl.vec_id = s.i AND sl.label < 5, emb_exact c
               JOIN embeddings cl ON cl.vec_id = c.i AND cl.label >= 5
               WHERE list_dot_product(s.e, c.e) >= 0.2 GROUP BY s.i) found USING (i)""",
    ),
)
def attach_by_embedding(spark, folder):
    vectors = bed.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("vec_id").cast("string").alias("subject"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        "label",
    )
    found = sb.attach_by_embedding(vectors.filter("label < 5"), vectors.filter("label >= 5"), 0.2)
    return found.select(
        F.col("subject").cast("long").alias("id"),
        F.col("parent").cast("long").alias("parent"),
        F.round("similarity", 6).alias("similarity"),
    )


@query(
    "rebuild_subjects",
    statement(
        _ATTACH_NAMES + " named",
        """SELECT i, string_agg(DISTINCT canonical, '; ' ORDER BY canonical) AS subjects,
                  string_agg(DISTINCT fine.subject, '; ' ORDER BY fine.subject) AS subjects_fine
           FROM items LEFT JOIN fine USING (i) LEFT JOIN named ON named.subject = fine.subject GROUP BY i""",
        {
            **_ATTACHED,
            "named": """SELECT subject, subject AS canonical FROM freq WHERE n >= 2
                        UNION ALL SELECT subject, parent FROM best""",
        },
    ),
)
def rebuild_subjects(spark, folder):
    items = bed.items(spark, folder)
    exploded = cut_lineage(sb.exploded_subjects(items))
    frequencies = sb.subject_frequencies(exploded)
    frequent = frequencies.filter("frequent").select("subject", F.col("subject").alias("canonical"))
    parents = sb.attach_by_ngrams(frequencies.filter("not frequent"), frequencies.filter("frequent"))
    rebuilt = sb.rebuild_subjects(items, exploded, sb.unified_map(frequent, parents))
    return rebuilt.select("i", F.col("Subjects").alias("subjects"), F.col("Subjects_fine").alias("subjects_fine"))


@query("subject_canonical_map")
def subject_canonical_map(spark, folder):
    return sb.canonical_map(sb.subject_frequencies(cut_lineage(sb.exploded_subjects(bed.items(spark, folder)))))


@query("canonical_catalogue")
def canonical_catalogue(spark, folder):
    done = canonicalise(bed.items_with_second_author(spark, folder))
    return done.select(
        "i",
        F.col("Author").alias("author"),
        F.col("Subjects").alias("subjects"),
        F.col("Subjects_fine").alias("subjects_fine"),
    )
