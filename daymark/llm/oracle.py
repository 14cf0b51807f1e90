"""SQL that says the same as the queries that SQL can express."""

from __future__ import annotations

from daymark.llm import divergence, mixing, rule_ledger
from daymark.llm.common import WORD

WORDS = f"""
numbered AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
words AS (SELECT r, doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM numbered)
"""

LEAKS = f"""
WITH {WORDS},
items AS (SELECT item_id, regexp_extract_all(text, '{WORD}') AS ws FROM benchmark WHERE text IS NOT NULL),
item_shingles AS (
    SELECT item_id, len(ws) AS k, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' '))) AS s
    FROM items WHERE len(ws) >= 5
),
item_counts AS (SELECT item_id, k, s, count(*) AS n FROM item_shingles GROUP BY ALL),
shingles AS (
    SELECT n.doc_id, n.r, len(n.ws) AS size, i - 1 AS at, array_to_string(n.ws[i : i + 4], ' ') AS s
    FROM numbered n, unnest(range(1, len(n.ws) - 3)) AS t(i) WHERE len(n.ws) >= 5
),
pairs AS (SELECT DISTINCT x.doc_id, x.r, x.size, c.item_id, c.k FROM shingles x JOIN item_counts c USING (s)),
windows AS (
    SELECT p.*, least(k, size) AS length, start
    FROM pairs p, unnest(range(0, size - least(k, size) + 1)) AS t(start)
),
inside AS (
    SELECT w.doc_id, w.r, w.item_id, w.k, w.length, w.start, x.s, count(*) AS n
    FROM windows w JOIN shingles x ON x.r = w.r AND x.at BETWEEN w.start AND w.start + w.length - 5
    GROUP BY ALL
),
scored AS (
    SELECT i.doc_id, i.item_id, i.start, i.length AS n_words,
           sum(least(i.n, coalesce(c.n, 0))) / (i.length - 4 + i.k - 4 - sum(least(i.n, coalesce(c.n, 0))))::DOUBLE AS similarity
    FROM inside i LEFT JOIN item_counts c ON c.item_id = i.item_id AND c.s = i.s
    GROUP BY i.doc_id, i.r, i.item_id, i.k, i.length, i.start
)
SELECT doc_id, item_id, CAST(n_words AS BIGINT) AS n_words, round(similarity, 9) AS similarity
FROM scored WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""

REPEATS = f"""
WITH {WORDS},
windows AS (
    SELECT r, i, w, count(*) OVER f AS n, string_agg(w, ' ') OVER f AS s
    FROM words WINDOW f AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
),
often AS (SELECT s FROM windows WHERE n = 35 GROUP BY s HAVING count(*) > 1),
marked AS (
    SELECT x.r, x.i, x.w, max(CASE WHEN x.n = 35 AND o.s IS NOT NULL THEN 1 ELSE 0 END)
           OVER (PARTITION BY x.r ORDER BY x.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
    FROM windows x LEFT JOIN often o ON x.s = o.s
),
summed AS (
    SELECT r, count(*) AS n_words, sum(gone) AS n_removed, string_agg(w, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept
    FROM marked GROUP BY r
)
SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM numbered LEFT JOIN summed USING (r)
"""

TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE {WORDS},
shingles AS (
    SELECT DISTINCT r, unnest(
        CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' '))
             WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s
    FROM numbered
),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY ALL),
links AS (
    SELECT a, b, c = x.n AND c = y.n AS copy FROM common JOIN sizes x ON a = x.r JOIN sizes y ON b = y.r
    WHERE 5 * c >= 4 * (x.n + y.n - c)
),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
classes AS (SELECT a AS r, min(n.doc_id) AS least FROM reach JOIN numbered n ON n.r = reach.b GROUP BY a),
counts AS (SELECT a AS r, count(*) AS n_links, count(*) FILTER (WHERE copy) AS n_copies FROM links GROUP BY a)
SELECT doc_id, coalesce(least(doc_id, classes.least), doc_id) AS class_id,
       CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, CAST(coalesce(n_copies, 0) AS BIGINT) AS n_copies,
       CAST(coalesce(n, 0) AS BIGINT) AS n_shingles
FROM numbered LEFT JOIN sizes USING (r) LEFT JOIN classes USING (r) LEFT JOIN counts USING (r)
"""

ORACLE_SQL = {
    "op3_decontaminate": LEAKS,
    "op4_suffix_dedup": REPEATS,
    "op5_mixing": mixing.ORACLE_SQL,
    "op7_topk_search": TOP_K,
    "op9_jaccard_join": NEAR_DUPLICATES,
    "op12_quality_rules": rule_ledger.ORACLE_SQL,
    "op13_source_divergence": divergence.ORACLE_SQL,
}
