"""DuckDB statements of the queries that SQL can express."""

from __future__ import annotations

# The patterns are those of the Spark side, in the escapes of SQL strings.
_QUALITY = r"""
WITH parts AS (
  SELECT doc_id,
         row_number() OVER () AS rid,
         coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         CASE WHEN text IS NULL THEN []::VARCHAR[] ELSE string_split(text, chr(10)) END AS lines
  FROM documents
),
windows AS (
  SELECT rid, i, array_to_string(words[i:i + 4], ' ') AS w
  FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM parts WHERE len(words) >= 5)
),
twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM windows) WHERE n > 1
),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY rid
),
each_line AS (
  SELECT rid, line FROM (SELECT rid, unnest(lines) AS line FROM parts) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
counted AS (
  SELECT rid, line, length(line) AS chars,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n_words,
         len(regexp_extract_all(line, '[.!?:;…。！？｡．।॥؟؛۔።፧፨။၊។៕།༎᠃։\x{0E01}-\x{0E2E}\x{0E81}-\x{0EAE}]')) AS marks,
         len(regexp_extract_all(line, '[!?]')) AS shouts,
         len(regexp_extract_all(line, '[|»›→•·]')) AS menus,
         len(regexp_extract_all(line, '[#*$%&<>{}=~^\\]')) AS symbols,
         regexp_matches(line, '(?i)(all rights reserved|cookie policy|privacy policy|terms of (use|service)|enable javascript|lorem ipsum|click here|sign in to|log in to|subscribe to our|add to cart|share this|skip to content)') AS boilerplate
  FROM each_line
),
lines AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup, sum(chars) AS chars_before,
         coalesce(sum(chars) FILTER (WHERE marks > 0 AND 100 * shouts <= 25 * n_words AND 100 * menus <= 25 * n_words
                                     AND 100 * symbols <= 10 * chars AND NOT boilerplate), 0) AS chars_after
  FROM counted GROUP BY rid
),
figures AS (
  SELECT p.doc_id,
         len(p.words)::BIGINT AS n_words,
         length(array_to_string(p.words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(p.text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(l.n_dup, 0)::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         coalesce(l.chars_before, 0)::BIGINT AS chars_before,
         coalesce(l.chars_after, 0)::BIGINT AS chars_after
  FROM parts p LEFT JOIN covered c USING (rid) LEFT JOIN lines l USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       (NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
        AND 100 * (chars_before - chars_after) <= 60 * chars_before) AS kept,
       chars_before, chars_after
FROM figures
"""

_LINES = r"""
WITH numbered AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
each_line AS (
  SELECT rid, doc_id, unnest(range(0, len(lines))) AS pos, unnest(lines) AS line FROM numbered
),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM each_line
),
repeated AS (
  SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT rid) >= 3
),
marked AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id IS DISTINCT FROM r.largest AS gone FROM keyed k LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid, doc_id
"""

_NEAR = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w
                      ELSE list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) END AS s
  FROM words
),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM members a JOIN members b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON e.a = r.other
),
smallest AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN smallest c USING (doc_id)
"""

# The CRC-32 of the decimal conv_id is worked out byte by byte; 3988292384 is its reflected polynomial.
_TRIE = r"""
WITH each_turn AS (
  SELECT conv_id, turn, role, md5(strlen(role)::VARCHAR || ':' || role || text) AS id,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
),
original AS (SELECT conv_id, list({'id': id, 'words': words} ORDER BY turn NULLS FIRST, role, id) AS turns FROM each_turn GROUP BY conv_id),
checked AS (
  SELECT conv_id, turns,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                         lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                               lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))),
             4294967295::BIGINT) % 4 AS h
  FROM original
),
rebuilt AS (
  SELECT c.conv_id, list_concat(CASE WHEN h = 0 OR b.turns IS NULL THEN [] ELSE b.turns[1:h] END, c.turns[h + 1:]) AS turns
  FROM checked c LEFT JOIN original b ON b.conv_id = c.conv_id - c.conv_id % 20
),
member AS (
  SELECT conv_id, d, array_to_string(list_transform(turns[1:d], lambda t: t.id), '') AS path,
         CASE WHEN d > 0 THEN turns[d].words ELSE 0 END AS w, len(turns) = d AS ends
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
),
node AS (
  SELECT d, path, left(path, 32 * (d - 1)) AS above, min(conv_id) AS conv_id, count(*) AS n, any_value(w) AS w,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ended
  FROM member GROUP BY d, path
),
below AS (SELECT d - 1 AS d, above AS path, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2),
subtree AS (
  SELECT a AS d, left(path, 32 * a) AS path, sum((n - 1) * w) AS saved, count(*) FILTER (WHERE n_children IS NULL) AS leaves
  FROM (SELECT d, path, n, w, n_children, unnest(range(0, d + 1)) AS a FROM node LEFT JOIN below USING (d, path))
  GROUP BY 1, 2
)
SELECT v.conv_id, v.d::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n::BIGINT AS n_convs,
       coalesce(b.n_children, 0)::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
       sha256(v.ended) AS ends_sha256
FROM node v LEFT JOIN node p ON v.d > 0 AND p.d = v.d - 1 AND p.path = v.above
LEFT JOIN below b ON b.d = v.d AND b.path = v.path JOIN subtree s ON s.d = v.d AND s.path = v.path
"""

_DECONTAMINATION = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
items AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(words[i:i + k - 1], ' ') AS w
  FROM (SELECT item_id, words, least(len(words), 10) AS k, unnest(range(1, greatest(len(words) - 8, 2))) AS i
        FROM items WHERE len(words) > 0)
),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (
  SELECT rid, i, k, array_to_string(words[i:i + k - 1], ' ') AS w
  FROM (SELECT rid, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM docs, sizes WHERE len(words) >= k)
),
found AS (SELECT rid, i, k, item_id FROM places JOIN windows USING (k, w)),
hits AS (SELECT rid, count(DISTINCT spot) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS spot FROM (SELECT DISTINCT rid, i, k FROM found)) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS name FROM found WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits h USING (rid) LEFT JOIN named m USING (rid)
"""

ORACLES: dict[str, str] = {
    "op2_line_dedup": _LINES,
    "op8_quality_rules": _QUALITY,
    "op10_minhash_near_dedup": _NEAR,
    "op12_conversation_prefix_trie": _TRIE,
    "op13_benchmark_decontamination": _DECONTAMINATION,
}
