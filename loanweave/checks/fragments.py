"""Named SQL sub-queries shared by the comparison statements."""

from __future__ import annotations

UNKNOWN = "'__UNKNOWN__'"

PARTS: dict[str, str] = {
    "loans": """
        SELECT o_custkey AS u, l_partkey AS i, CAST(epoch(l_shipdate) AS BIGINT) AS t
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "items": """
        SELECT '  ' || p_name || '  /' AS "Title",
               CASE WHEN p_partkey % 7 <> 0
                    THEN p_brand || ', ' || p_name || ', 19' || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') || '-'
               END AS "Author",
               '978-' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') || ' ; '
                 || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || '-x' AS "ISBN Valid",
               CASE WHEN p_partkey % 11 <> 0
                    THEN p_brand || '  ' || p_type || '  ' || CAST(p_size % 10 AS VARCHAR) END AS "Publisher",
               CASE WHEN p_partkey % 9 <> 0
                    THEN upper(split_part(p_name, ' ', 1)) || ' ; ' || split_part(p_name, ' ', 2) || ' ;  ; '
                         || p_type || ' ; ' || p_brand || ' ; ' || p_name || ' -- ' || p_brand || ', 19'
                         || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') END AS "Subjects",
               p_partkey AS i
        FROM part""",
    "clean": f"""
        SELECT i,
               regexp_replace(regexp_replace(trim("Title"), '\\s+', ' ', 'g'), '\\s*/\\s*$', '') AS title_clean,
               CASE WHEN "Author" IS NULL THEN {UNKNOWN}
                    ELSE regexp_replace(trim(lower(regexp_replace(trim("Author"), ',?\\s*\\d{{4}}-?\\d{{0,4}}\\.?$', ''))),
                                        '\\s+', ' ', 'g') END AS author_clean,
               CASE WHEN "Publisher" IS NULL THEN {UNKNOWN}
                    ELSE regexp_replace(trim("Publisher"), '\\s+', ' ', 'g') END AS publisher_clean,
               CASE WHEN "Subjects" IS NULL THEN []
                    ELSE list_filter(list_transform(string_split("Subjects", ';'), lambda x: lower(trim(x))),
                                     lambda x: x <> '') END AS subjects_list
        FROM items WHERE i IN (SELECT i FROM loans)""",
    "tags": """
        SELECT i, unnest(subjects_list) AS subject, generate_subscripts(subjects_list, 1) - 1 AS pos FROM clean""",
    "vocab": """
        SELECT subject, n, row_number() OVER (ORDER BY subject) - 1 AS subject_idx
        FROM (SELECT subject, count(*) AS n FROM tags GROUP BY subject HAVING count(*) >= 5
              ORDER BY n DESC, subject LIMIT 5000)""",
    "ranked": """
        SELECT u, i, t, row_number() OVER (PARTITION BY u, i ORDER BY t) AS interaction_rank FROM loans""",
    "split": """
        SELECT u, i, t, CASE WHEN p < n * 6 // 10 THEN 'train' WHEN p < n * 8 // 10 THEN 'test' ELSE 'val' END AS split
        FROM (SELECT u, i, t, row_number() OVER (PARTITION BY u ORDER BY t, i) - 1 AS p,
                     count(*) OVER (PARTITION BY u) AS n FROM loans) WHERE n >= 3""",
    "authors": """
        SELECT label, frequent, row_number() OVER (ORDER BY label) - 1 AS code
        FROM (SELECT CASE WHEN n >= 2 THEN author_clean ELSE '__RARE_AUTHOR__' END AS label, max(n >= 2) AS frequent
              FROM (SELECT author_clean, count(*) AS n FROM clean GROUP BY author_clean) GROUP BY 1)""",
    "publishers": """
        SELECT label, frequent, row_number() OVER (ORDER BY label) - 1 AS code
        FROM (SELECT CASE WHEN n >= 3 THEN publisher_clean ELSE '__RARE_PUBLISHER__' END AS label,
                     max(n >= 3) AS frequent
              FROM (SELECT publisher_clean, count(*) AS n FROM clean GROUP BY publisher_clean) GROUP BY 1)""",
    "coded": """
        SELECT c.i, c.author_clean, c.publisher_clean,
               coalesce(a.code, (SELECT code FROM authors WHERE label = '__RARE_AUTHOR__')) AS author_code,
               coalesce(p.code, (SELECT code FROM publishers WHERE label = '__RARE_PUBLISHER__')) AS publisher_code
        FROM clean c LEFT JOIN authors a ON a.label = c.author_clean AND a.frequent
        LEFT JOIN publishers p ON p.label = c.publisher_clean AND p.frequent""",
    "tf": """
        SELECT i, subject_idx, count(*) AS tf FROM tags JOIN vocab USING (subject) GROUP BY i, subject_idx""",
    "weights": """
        SELECT i, subject_idx, raw / sqrt(sum(raw * raw) OVER (PARTITION BY i)) AS weight
        FROM (SELECT i, subject_idx,
                     tf * (ln((1.0 + (SELECT count(*) FROM clean))
                              / (1.0 + count(*) OVER (PARTITION BY subject_idx))) + 1.0) AS raw FROM tf)""",
    "ratings": "SELECT u, i, CAST(count(*) AS DOUBLE) AS r FROM loans GROUP BY u, i",
    "unorm": "SELECT u, sqrt(sum(r * r)) AS norm FROM ratings GROUP BY u",
    "inorm": "SELECT i, sqrt(sum(r * r)) AS norm FROM ratings GROUP BY i",
    "alike": """
        SELECT a.i, b.i AS neighbour, sum(a.r * b.r / (x.norm * y.norm)) AS similarity
        FROM ratings a JOIN ratings b ON a.u = b.u AND a.i <> b.i
        JOIN inorm x ON x.i = a.i JOIN inorm y ON y.i = b.i GROUP BY a.i, b.i""",
    "neighbours": """
        SELECT * FROM (SELECT i, neighbour, similarity,
                              row_number() OVER (PARTITION BY i ORDER BY round(similarity, 9) DESC, neighbour) AS rank
                       FROM alike) WHERE rank <= 100""",
    "item_item": """
        SELECT r.u, n.neighbour AS i, sum(r.r * n.similarity) AS score
        FROM ratings r JOIN neighbours n ON n.i = r.i GROUP BY r.u, n.neighbour""",
    "carried": """
        SELECT a.i AS j, b.i, sum(a.r * b.r / n.norm) AS m
        FROM ratings a JOIN ratings b ON a.u = b.u JOIN unorm n ON n.u = a.u GROUP BY a.i, b.i""",
    "user_user": """
        SELECT u, i, sum(s) AS score FROM (
            SELECT r.u, c.i, r.r / n.norm * c.m AS s FROM ratings r JOIN unorm n USING (u) JOIN carried c ON c.j = r.i
            UNION ALL SELECT u, i, -r FROM ratings) GROUP BY u, i HAVING sum(s) > 1e-9""",
    "overlap": """
        SELECT p.u, g.i, CAST(count(*) AS DOUBLE) AS score
        FROM (SELECT DISTINCT u, subject FROM ratings JOIN tags USING (i)) p
        JOIN (SELECT DISTINCT i, subject FROM tags) g USING (subject) GROUP BY p.u, g.i""",
    "popular": """
        SELECT i, borrow_count, row_number() OVER (ORDER BY borrow_count DESC, i) - 1 AS place
        FROM (SELECT i, count(*) AS borrow_count FROM loans GROUP BY i)""",
    "emb": """
        SELECT vec_id AS i, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings""",
    "emb_long": "SELECT i, unnest(e) AS x, generate_subscripts(e, 1) - 1 AS pos FROM emb",
    "profile_long": """
        SELECT u, pos, coalesce(total, 0) / n AS x, coalesce(total, 0) AS total
        FROM (SELECT u, sum(r) AS n FROM ratings GROUP BY u) CROSS JOIN (SELECT unnest(range(64)) AS pos)
        LEFT JOIN (SELECT u, pos, sum(r * x) AS total FROM ratings JOIN emb_long USING (i) GROUP BY u, pos)
        USING (u, pos)""",
    "profiles": """
        SELECT u, list(x ORDER BY pos) AS e, sqrt(sum(x * x)) AS len FROM profile_long GROUP BY u""",
    "emb_unit": """
        SELECT i, list_transform(e, lambda x: x / (sqrt(list_dot_product(e, e)) + 1e-8)) AS e FROM emb""",
    "emb_exact": "SELECT i, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM emb",
    "profile_unit": """
        SELECT u, list_transform(e, lambda x: x / (len + 1e-8)) AS e FROM profiles""",
}


def statement(names: str, body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` the named parts, in the given order, and the final select."""
    parts = {**PARTS, **(extra or {})}
    return "WITH " + ",\n".join(f"{name} AS ({parts[name]})" for name in names.split()) + "\n" + body
