"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations


def ascii_lower(column: str) -> str:
    return f"translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP9 = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({ascii_lower('text')}, '{ALNUM}') AS w FROM documents
), docs AS MATERIALIZED (SELECT r, doc_id, w, len(w) AS n_words FROM d),
items AS MATERIALIZED (
    SELECT item_id, w, least(13, len(w)) AS n
    FROM (SELECT item_id, regexp_extract_all({ascii_lower('text')}, '{ALNUM}') AS w FROM benchmark) WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM items)
), widths AS (SELECT DISTINCT n FROM items),
places AS (
    SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM (SELECT r, w, n, unnest(range(1, n_words - n + 2)) AS i FROM docs, widths WHERE n_words >= n)
), found AS MATERIALIZED (SELECT r, n, i, item_id FROM places JOIN windows USING (n, g)),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
listed AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= n_words AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN listed USING (r)
"""

BLANK = r"[^\x20\x09-\x0D]+"

OP3 = f"""
WITH RECURSIVE d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({ascii_lower('text')}, '{BLANK}') AS w FROM documents
), g AS MATERIALIZED (
    SELECT DISTINCT r, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') AS s
    FROM (SELECT r, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM d WHERE len(w) > 0)
), sizes AS MATERIALIZED (SELECT r, count(*) AS n FROM g GROUP BY r),
shared AS MATERIALIZED (
    SELECT a.r AS x, b.r AS y, count(*) AS n FROM g AS a JOIN g AS b ON a.s = b.s AND a.r < b.r GROUP BY ALL
), links AS MATERIALIZED (
    SELECT x, y FROM shared JOIN sizes AS p ON p.r = x JOIN sizes AS q ON q.r = y
    WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)
), ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(r, y) AS (
    SELECT DISTINCT x, x FROM ways
    UNION
    SELECT reach.r, ways.y FROM reach JOIN ways ON ways.x = reach.y
), least_id AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.y GROUP BY reach.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM d LEFT JOIN sizes USING (r) LEFT JOIN least_id USING (r)
"""

OP4 = f"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS MATERIALIZED (
    SELECT r, place, line, list_sort(list_distinct(regexp_extract_all({ascii_lower('line')}, '{BLANK}'))) AS s
    FROM (SELECT r, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM d)
), classes AS MATERIALIZED (
    SELECT s, len(s) AS n, min(r * 1000000 + place) AS first, row_number() OVER () AS c FROM l WHERE len(s) > 0 GROUP BY s
), w AS MATERIALIZED (SELECT c, n, unnest(s) AS word FROM classes),
often AS (SELECT word, count(*) AS k FROM w GROUP BY word),
ranked AS MATERIALIZED (SELECT c, n, word, row_number() OVER (PARTITION BY c ORDER BY k, word) AS i FROM w JOIN often USING (word)),
rare AS MATERIALIZED (SELECT c, n, word FROM ranked WHERE i <= n - ceil(0.8 * n - 1e-9) + 1),
near AS MATERIALIZED (
    SELECT DISTINCT a.c AS x, b.c AS y FROM rare AS a JOIN rare AS b
    ON a.word = b.word AND a.c < b.c AND 10 * least(a.n, b.n) >= 8 * greatest(a.n, b.n)
), matches AS MATERIALIZED (
    SELECT p.first AS px, q.first AS py, x, y FROM near JOIN classes AS p ON p.c = x JOIN classes AS q ON q.c = y
    WHERE 100 * len(list_intersect(p.s, q.s)) >= 80 * (p.n + q.n - len(list_intersect(p.s, q.s)))
), gone AS (SELECT DISTINCT CASE WHEN px < py THEN y ELSE x END AS c FROM matches),
judged AS (
    SELECT l.r, l.place, l.line, classes.c IS NOT NULL AS counts,
           classes.c IS NOT NULL AND (gone.c IS NOT NULL OR l.r * 1000000 + l.place <> classes.first) AS removed
    FROM l LEFT JOIN classes ON l.s = classes.s LEFT JOIN gone ON gone.c = classes.c
)
SELECT any_value(doc_id) AS doc_id, count(*) FILTER (counts) AS n_lines, count(*) FILTER (removed) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT removed), '')) AS kept_sha256
FROM judged JOIN d USING (r) GROUP BY r
"""


OP11 = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({ascii_lower('text')}, '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)
), f AS MATERIALIZED (SELECT lang, k, p, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
phrases AS MATERIALIZED (SELECT lang, k, p, a, string_split(p, ' ') AS w FROM f WHERE k > 1),
covered AS (
    SELECT DISTINCT s.lang, s.p FROM phrases AS s JOIN (
        SELECT lang, a, k, j, array_to_string(w[i:i + j - 1], ' ') AS part
        FROM (SELECT lang, a, k, j, w, unnest(range(1, k - j + 2)) AS i FROM phrases, (SELECT unnest(range(2, 5)) AS j) WHERE j < k)
    ) AS o ON o.lang = s.lang AND o.part = s.p AND 100 * o.a >= 100 * s.a
), cuts AS (
    SELECT x.lang, x.p, x.a, x.c, l.a AS l, r.a AS r, n,
           CAST(CAST(1000 AS HUGEINT) * x.a * n // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
    FROM (SELECT lang, p, a, k, w, unnest(range(1, k)) AS c FROM phrases) AS x
    JOIN f AS l ON l.lang = x.lang AND l.p = array_to_string(x.w[1:x.c], ' ')
    JOIN f AS r ON r.lang = x.lang AND r.p = array_to_string(x.w[x.c + 1:x.k], ' ')
    JOIN totals ON totals.lang = x.lang
), weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, CAST(p AS BLOB)) AS rank, p AS phrase, a, l, r, n, score
FROM weakest ANTI JOIN covered USING (lang, p) QUALIFY rank <= 2000
"""

OP13 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_near_duplicates": OP3, "op4_line_matches": OP4, "op9_winnowing": OP9, "op11_collocations": OP11, "op13_exact_copies": OP13}
