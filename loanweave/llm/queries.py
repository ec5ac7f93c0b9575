"""Registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

Run = Callable[[SparkSession, str], DataFrame]
RUNS: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Run) -> Run:
        RUNS[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


#: The rules of op10, as (kind, host, path).
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query("op1_language_id")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    from . import language_id

    documents = table(spark, folder, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    model = language_id.fit(documents.filter(~held_out))
    found = language_id.identify(documents, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


@query(
    "op2_quality_rules",
    r"""
    WITH base AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM base),
    grams AS (SELECT rid, [ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] FOR p IN range(1, len(ws) - 1)] AS gs FROM w),
    tri AS (SELECT rid, unnest(gs) AS g, generate_subscripts(gs, 1) AS p FROM grams),
    twice AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS n FROM tri) WHERE n > 1),
    covered AS (SELECT rid, count(DISTINCT p + d) AS n FROM twice, (VALUES (0), (1), (2)) AS v(d) GROUP BY rid),
    m AS (SELECT doc_id, len(ws) AS n_words, coalesce(list_sum([length(x) FOR x IN ws]), 0) AS word_chars,
                 length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                 len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
                 coalesce(covered.n, 0) AS n_repeat_words,
                 len(list_filter(ws, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter_words,
                 length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals,
                 length(t) - length(replace(t, '!', '')) AS n_exclamations
          FROM w LEFT JOIN covered USING (rid)),
    j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
           n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
           NOT (base_failed OR word_chars < 3 * n_words OR word_chars > 12 * n_words OR 100 * n_symbols > 10 * n_words
                OR 100 * n_dup_lines > 50 * n_lines OR 100 * n_letter_words < 70 * n_words
                OR 100 * n_capitals > 30 * word_chars OR 100 * n_exclamations > 30 * n_words) AS kept
    FROM j
    """,
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    from . import quality_rules as q

    entries = q.ledger(table(spark, folder, "documents"))
    measured = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return entries.select(*measured, q.fails(q.BASE).alias("base_failed"), (~q.fails(q.CURRENT)).alias("kept"))


@query("op3_html_extraction")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    from . import html_extraction

    found = html_extraction.extract(table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query("op4_decontamination")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    from . import decontamination

    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op5_packing")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    from . import packing

    return packing.pack(table(spark, folder, "documents"))


@query(
    "op6_minhash_near_dedup",
    r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS ws FROM documents),
    g AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                 ELSE [array_to_string(ws[p:p + 4], ' ') FOR p IN range(1, len(ws) - 3)] END) AS gs FROM w),
    e AS (SELECT doc_id, len(gs) AS n, unnest(gs) AS s FROM g),
    c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common, any_value(a.n) AS na, any_value(b.n) AS nb
          FROM e a JOIN e b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
    l AS (SELECT a, b FROM c WHERE 100 * common >= 85 * (na + nb - common)),
    both_ways AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
    reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
    low AS (SELECT a AS doc_id, min(b) AS least_id FROM reach GROUP BY a)
    SELECT doc_id, len(gs)::BIGINT AS n_shingles, least(doc_id, coalesce(least_id, doc_id)) AS component_id,
           doc_id = least(doc_id, coalesce(least_id, doc_id)) AS kept
    FROM g LEFT JOIN low USING (doc_id)
    """,
)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    from . import near_duplicates

    return near_duplicates.near_duplicates(table(spark, folder, "documents")).drop("row_key")


@query("op7_sharding")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    from . import sharding
    from .common import written

    slotted = sharding.with_slots(table(spark, folder, "documents"))
    sizes = sharding.slot_sizes(slotted)
    owner = sharding.plan(sizes, 40)
    slot_map = written(sharding.map_table(spark, 1, owner, sizes), "slot-map")
    placed = sharding.assign(slotted, slot_map)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot"
    )


@query("op8_repeated_spans")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    from . import repeated_spans

    found = repeated_spans.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op9_secret_scans")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    from . import secret_scans as s

    scanned = s.scan(table(spark, folder, "documents"))
    base = F.filter("_spans", lambda x: x["kind"] < s.KINDS.index("entropy"))
    return scanned.select(
        "doc_id",
        *(s.count_of(k).alias(f"n_{k}") for k in s.KINDS[:3]),
        F.sha2(s.described(base), 256).alias("base_sha256"),
        s.described(F.col("_spans")).alias("spans"),
    )


@query(
    "op10_url_filters",
    r"""
    WITH rules(kind, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
        ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
    rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
    parts AS (SELECT row_number() OVER () AS rid, page_id,
                     translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
    hits AS (SELECT p.rid, arg_max(struct_pack(k := r.kind, rule := r.host || r.path), length(r.host) * 100000 + length(r.path)) AS best
             FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY p.rid)
    SELECT page_id, host, path, best.rule AS rule, coalesce(best.k, 'allow') AS verdict FROM parts LEFT JOIN hits USING (rid)
    """,
)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    from . import url_filters

    rules = spark.createDataFrame(URL_RULES, "kind string, host string, path string")
    judged = url_filters.judge(table(spark, folder, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")

@query(
    "op11_lexical_search",
    r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
    i AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM benchmark),
    c AS (SELECT count(*) AS docs, sum(len(ws))::BIGINT AS terms FROM d WHERE len(ws) > 0),
    asked AS (SELECT q, term, count(*) AS repeats FROM (SELECT q, unnest(ws) AS term FROM i) GROUP BY q, term),
    tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
    w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c),
    m AS (SELECT r, doc_id, 25 + (75 * len(ws) * docs) // terms AS m FROM d, c WHERE len(ws) > 0),
    s AS (SELECT q, r, any_value(doc_id) AS doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
          FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY q, r),
    ranked AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN i USING (q) WHERE rank <= 10
    """,
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    from . import lexical_search

    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))

@query(
    "op12_hard_negatives",
    r"""
    WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS vec
               FROM embeddings
               WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.r AS ar, b.r AS br, a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
                 list_sum([p[1] * p[2] FOR p IN list_zip(a.vec, b.vec)])::BIGINT AS score
          FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
    p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) <= 5),
    n AS (SELECT p.anchor_id, p.vec_id AS positive_id,
                 row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s.score DESC, s.vec_id) AS rank,
                 s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
          FROM p JOIN s ON p.ar = s.ar AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
    """,
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    from . import hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    is_anchor = (F.col("vec_id") % 50 == 0).alias("is_anchor")
    rows = table(spark, folder, "embeddings").select("vec_id", label.alias("label"), F.col("embedding").alias("vector"), is_anchor)
    return hard_negatives.mine(rows)

@query("op13_bpe")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    from . import bpe

    found = bpe.round_trip(table(spark, folder, "documents"))
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    decoded = F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256")
    return found.select("doc_id", n_tokens, F.sha2("ids", 256).alias("ids_sha256"), decoded)
