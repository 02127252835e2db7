"""DuckDB SQL for the operators that SQL can express."""

from barloom.llm.common import LOWER, UPPER

_LOWERED = "translate(coalesce(text, ''), '" + UPPER + "', '" + LOWER + "')"

EXACT_DEDUP = f"""WITH d AS (SELECT doc_id, {_LOWERED} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, coalesce(doc_id = max(doc_id) OVER g, false) AS kept, sha256(t) AS text_sha256 FROM d WINDOW g AS (PARTITION BY t)"""

_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda i: array_to_string(w[i : i + least(13, len(w)) - 1], ' '))) AS s FROM b WHERE len(w) > 0),
l AS (SELECT DISTINCT n FROM p), pos AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, l WHERE len(w) >= n),
h AS (SELECT pos.doc_id, pos.i, pos.n, p.item_id FROM pos JOIN p ON p.n = pos.n AND p.s = array_to_string(pos.w[pos.i : pos.i + pos.n - 1], ' ')),
k AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN m USING (doc_id)"""

NEAR_DEDUP = rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS x FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_n >= 80 * (x.n + y.n - both_n)), u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, u.b FROM r JOIN u ON u.a = r.b),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN m USING (doc_id)"""

#: Bytes as pairs of hexadecimal digits. Runs of windows that start earlier, then maximal runs of removed bytes.
SUFFIX_DEDUP = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(len(h) // 2 AS BIGINT) AS n FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM d WHERE n >= 100)),
m AS (SELECT s, min({'d': doc_id, 'i': i}) AS f FROM w GROUP BY s HAVING count(*) > 1),
r AS (SELECT doc_id, i FROM w JOIN m USING (s) WHERE f != {'d': doc_id, 'i': i}),
g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS first FROM r),
k AS (SELECT doc_id, i, sum(first) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g),
p AS (SELECT doc_id, k, min(i) AS low, max(i) + 100 AS high FROM k GROUP BY doc_id, k),
q AS (SELECT doc_id, h, n, coalesce(low, n) AS low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS before, lead(low) OVER (PARTITION BY doc_id ORDER BY low) AS after FROM d LEFT JOIN p USING (doc_id))
SELECT doc_id, any_value(n) AS n_bytes, CAST(coalesce(sum(high - low), 0) AS BIGINT) AS n_removed, count(high) AS n_spans,
  sha256(unhex(string_agg(substr(h, 2 * before + 1, 2 * (low - before)) || CASE WHEN after IS NULL AND high IS NOT NULL THEN substr(h, 2 * high + 1) ELSE '' END, '' ORDER BY low))) AS kept_sha256,
  coalesce(string_agg(low || ':' || high, ',' ORDER BY low) FILTER (high IS NOT NULL), '') AS removed
FROM q GROUP BY doc_id"""
