"""SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
        ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(na.n) + any_value(nb.n) - count(*))
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""

PASSAGES = f"""
WITH dw AS (
    SELECT DISTINCT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS ws FROM documents
), iw AS (
    SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS ws FROM benchmark
), ds AS (
    SELECT doc_id, len(ws) AS n, p, array_to_string(ws[p:p + 4], ' ') AS s
    FROM (SELECT *, unnest(range(1, len(ws) - 3)) AS p FROM dw WHERE len(ws) >= 5)
), its AS (
    SELECT item_id, len(ws) AS n, p, array_to_string(ws[p:p + 4], ' ') AS s
    FROM (SELECT *, unnest(range(1, len(ws) - 3)) AS p FROM iw WHERE len(ws) >= 5)
), places AS (
    SELECT DISTINCT ds.doc_id, its.item_id, its.n AS item_n, least(its.n, ds.n) AS n,
        least(greatest(ds.p - its.p, 0), greatest(ds.n - its.n, 0)) AS start
    FROM ds JOIN its ON ds.s = its.s
), a AS (
    SELECT pl.doc_id, pl.item_id, pl.item_n, pl.n, pl.start, ds.s, count(*) AS c FROM places pl
    JOIN ds ON ds.doc_id = pl.doc_id AND ds.p BETWEEN pl.start + 1 AND pl.start + pl.n - 4 GROUP BY ALL
), b AS (SELECT item_id, s, count(*) AS c FROM its GROUP BY ALL
), judged AS (
    SELECT a.doc_id, a.item_id, a.start, a.n, a.item_n, sum(least(a.c, b.c)) AS common
    FROM a JOIN b ON a.item_id = b.item_id AND a.s = b.s GROUP BY ALL
), good AS (
    SELECT *, n - 4 + item_n - 4 - common AS total FROM judged WHERE 100 * common >= 80 * (n - 4 + item_n - 4 - common)
)
SELECT doc_id, item_id, start::BIGINT AS start, n::BIGINT AS n_words, common::BIGINT AS common, total::BIGINT AS total
FROM good QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY common / total DESC, start) = 1
"""


NEAREST = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


LEXICAL = rf"""
WITH t AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM documents
), n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id
), totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM n
), tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL
), w AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, totals GROUP BY term
), i AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark
), s AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length))))::BIGINT AS score
    FROM i JOIN tf USING (term) JOIN w USING (term) JOIN n USING (doc_id), totals GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_minhash_join": NEAR_DUPLICATES, "op8_simhash_windows": PASSAGES, "op11_columnar_search": NEAREST, "op12_rmq_search": LEXICAL}
