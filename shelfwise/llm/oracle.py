"""DuckDB SQL for the corpus queries that SQL can express."""

#: The whole ledger, with windows compared as strings of words.
QUALITY_RULES = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, [x FOR x IN regexp_split_to_array(t, '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM d),
pos AS (SELECT rid, w, unnest(generate_series(1, len(w) - 7)) AS i FROM w WHERE len(w) >= 8),
win AS (SELECT rid, i, array_to_string(list_slice(w, i, i + 7), ' ') AS k FROM pos),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, i + j AS p FROM rep, (SELECT unnest(generate_series(0, 7)) AS j)) GROUP BY rid),
stu AS (SELECT rid, count(*) AS n FROM (SELECT rid, unnest(list_slice(w, 1, len(w) - 1)) AS a, unnest(list_slice(w, 2, len(w))) AS b FROM w WHERE len(w) > 1) WHERE a = b GROUP BY rid),
l AS (SELECT rid, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM d),
m AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS BIGINT) AS n_upper,
  CAST(length(regexp_replace(t, '[^!]+', '', 'g')) AS BIGINT) AS n_exclamations,
  CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
  coalesce(stu.n, 0) AS n_stutter_words, coalesce(cov.n, 0) AS n_repeat_words
  FROM w JOIN l USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN stu USING (rid)),
b AS (SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
  + 8 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT + 16 * (10 * n_upper > 3 * word_chars)::INT
  + 32 * (2 * n_dup_lines > n_lines)::INT + 64 * (5 * n_stutter_words > n_words)::INT + 128 * (10 * n_exclamations > 3 * n_words)::INT AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  (fail_bits & 3) <> 0 AS base_failed, (fail_bits & 255) = 0 AS kept, fail_bits FROM b
"""

#: List events replayed per entry; a capture takes the last event on or before its fetch date.
URL_FILTERS = r"""
WITH p AS (SELECT row_number() OVER () AS c, page_id, url, DATE '2023-01-01' + CAST(((page_id % 730) + 730) % 730 AS INTEGER) AS fetched_on,
  lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
  regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1) AS path FROM pages),
s AS (SELECT *, string_split(host, '.') AS l, [x FOR x IN string_split(path, '/') IF x <> ''] AS g FROM p WHERE host <> ''),
k AS (SELECT DISTINCT c, key FROM (
  SELECT c, 'host:' || array_to_string(list_slice(l, i, len(l)), '.') AS key FROM s, LATERAL (SELECT unnest(generate_series(1, len(l))) AS i)
  UNION ALL SELECT c, 'path:' || host || '/' || array_to_string(list_slice(g, 1, i), '/') FROM s, LATERAL (SELECT unnest(generate_series(1, least(len(g), 3))) AS i)
  UNION ALL SELECT c, 'url:' || host || '/' || array_to_string(g, '/') FROM s)),
n AS (SELECT key, CAST('0x' || substr(md5(key), 1, 8) AS BIGINT) AS n FROM (SELECT DISTINCT key FROM k)),
a AS (SELECT key, n, DATE '2022-10-01' + CAST(n // 4 % 700 AS INTEGER) AS added, CASE WHEN n // 16 % 3 = 0 THEN 'allow' ELSE 'block' END AS effect FROM n WHERE n % 4 = 0),
e AS (SELECT key, effect, added AS day, true AS on_ FROM a
  UNION ALL SELECT key, effect, added + CAST(20 + n // 64 % 90 AS INTEGER), false FROM a
  UNION ALL SELECT key, effect, added + CAST(150 + n // 256 % 90 AS INTEGER), true FROM a),
m AS (SELECT c, key, effect FROM (
  SELECT k.c, k.key, e.effect, e.on_, row_number() OVER (PARTITION BY k.c, k.key ORDER BY e.day DESC, e.on_ DESC) AS r
  FROM k JOIN p USING (c) JOIN e ON e.key = k.key AND e.day <= p.fetched_on) WHERE r = 1 AND on_),
f AS (SELECT c, count(*) FILTER (effect = 'block') AS b, count(*) FILTER (effect = 'allow') AS w, min(key) FILTER (effect = 'block') AS first_entry FROM m GROUP BY c)
SELECT page_id, CAST(fetched_on AS VARCHAR) AS fetched_on, coalesce(b, 0) AS n_block, coalesce(w, 0) AS n_allow, first_entry, coalesce(b, 0) > 0 AND coalesce(w, 0) = 0 AS blocked
FROM p LEFT JOIN f USING (c)
"""

#: Units as a list; cuts, form and output by list slices; the restored text is the text itself.
FILL_IN_MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
  CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, t, n, form, coalesce(array_to_string(list_slice(u, 1, a), ''), '') AS p, coalesce(array_to_string(list_slice(u, a + 1, b), ''), '') AS m,
  coalesce(array_to_string(list_slice(u, b + 1, n), ''), '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
"""
