"""DuckDB statements with the rows of the registered corpus queries."""

from clickpath.llm import line_rules

OP1_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k,
         array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
dg AS (
  SELECT doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, ks WHERE len(w) >= k)),
occ AS (SELECT dg.doc_id, dg.i, dg.k, win.item_id FROM dg JOIN win ON dg.g = win.g AND dg.k = win.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS l
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP9_SQL = r"""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

# bytes as two hex digits each; windows are compared by their MD5
OP8_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 399)) AS i FROM d WHERE len(h) >= 800),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS g FROM s),
r AS (SELECT doc_id, i FROM w WHERE g IN (SELECT g FROM w GROUP BY g HAVING count(*) > 1)),
b AS (SELECT doc_id, i, coalesce(i > 400 + lag(i) OVER (PARTITION BY doc_id ORDER BY i), true) AS new FROM r),
m AS (
  SELECT doc_id, min(i) AS a, max(i) + 400 AS z
  FROM (SELECT doc_id, i, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM b) GROUP BY doc_id, run),
p AS (
  SELECT doc_id, a, z, coalesce(lag(z) OVER o, 0) AS kept_from, lead(a) OVER o IS NULL AS last FROM m WINDOW o AS (PARTITION BY doc_id ORDER BY a)),
k AS (
  SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed,
         string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)) || CASE WHEN last THEN substr(h, 2 * z + 1) ELSE '' END, '' ORDER BY a) AS kept
  FROM p JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM g),
x AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM r WHERE k > 1)),
kept AS (
  SELECT u.doc_id, string_agg(u.word, ' ' ORDER BY u.p) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) u
  ANTI JOIN x ON u.doc_id = x.doc_id AND u.p = x.p GROUP BY u.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(len(w), 4) - 1), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (
  SELECT x, y FROM o JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.y) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.x = d.doc_id GROUP BY 1, 2
"""

_OP12_LINES = f"""
  SELECT doc_id, line, w, len(regexp_extract_all(line, '{line_rules.ODD_MARKS}')) AS odd,
         len(regexp_extract_all(line, '{line_rules.SEPARATORS}')) AS seps, len(regexp_extract_all(line, '{line_rules.MENU_WORDS}')) AS menus,
         regexp_matches(line, '{line_rules.SENTENCE_MARKS}') AS marked, regexp_matches(line, '{line_rules.PHRASES}') AS phrase
  FROM (SELECT doc_id, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS w
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)) WHERE w > 0
"""

OP12_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
l AS MATERIALIZED ({_OP12_LINES}),
lost AS (
  SELECT doc_id, sum(w) AS n FROM l
  WHERE (odd >= {line_rules.ODD_LEAST} AND 100 * odd >= {line_rules.ODD_PERCENT} * w) OR (w >= {line_rules.LONG_LINE} AND NOT marked)
     OR (w <= {line_rules.NAVIGATION_WORDS} AND 2 * menus >= w) OR (seps >= 2 AND 100 * seps >= {line_rules.SEPARATOR_PERCENT} * w)
     OR (w <= {line_rules.BOILERPLATE_WORDS} AND phrase) GROUP BY doc_id),
dup AS (SELECT doc_id, sum(c - 1) AS n FROM (SELECT doc_id, line, count(*) AS c FROM l GROUP BY doc_id, line) GROUP BY doc_id),
g AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM g),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM r WHERE c > 1) GROUP BY doc_id),
a AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_lost_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.REPEAT_PERCENT} * n_words)
         AND 100 * n_lost_words <= {line_rules.LOSS_PERCENT} * n_words AS kept
FROM a
"""

OP13_SQL = r"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

ORACLE_SQL = {
    "op1_decontaminate": OP1_SQL,
    "op5_ngram_jaccard_join": OP5_SQL,
    "op8_suffix_dedup": OP8_SQL,
    "op9_warc": OP9_SQL,
    "op10_substring_dedup": OP10_SQL,
    "op12_line_rules": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
