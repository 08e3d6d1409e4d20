"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

from adsift.llm.oracle_models import CONVERSATION_REPAIR, VECTOR_CODES

_WS = r"chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"

ORACLE = {
    "op7_span_dedup": rf"""
WITH whole AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^.!?\n]*[.!?\n]+|[^.!?\n]+')) AS piece,
         generate_subscripts(regexp_extract_all(coalesce(text, ''), '[^.!?\n]*[.!?\n]+|[^.!?\n]+'), 1) AS i
  FROM documents),
sized AS (SELECT *, length(piece) - length(replace(piece, ' ', '')) + 1 > 25 AS long,
                 regexp_extract(piece, '[.!?\n]*$') AS stop FROM whole),
cut AS (
  SELECT doc_id, i, unnest(CASE WHEN long THEN list_concat(parts[:-2], [parts[-1] || stop]) ELSE [piece] END) AS piece,
         generate_subscripts(parts, 1) AS j
  FROM (SELECT *, CASE WHEN long THEN string_split(rtrim(array_to_string(list_transform(
            regexp_extract_all(left(piece, length(piece) - length(stop)), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+'),
            lambda t: CASE WHEN length(trim(t, {_WS})) IN (7, 14) THEN t || chr(10) ELSE t END), ''), chr(10)), chr(10))
          ELSE [piece] END AS parts FROM sized)),
p AS (SELECT doc_id, piece, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS i FROM cut),
k AS (SELECT *, translate(trim(piece, {_WS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM p),
s AS (SELECT doc_id, i, key, length(key) - length(replace(key, ' ', '')) + 1 AS words,
             row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM k WHERE key <> ''),
r AS (
  SELECT doc_id, n, CASE WHEN words >= 20 THEN key
    WHEN words + lead(words) OVER w >= 20 THEN key || chr(0) || lead(key) OVER w
    ELSE key || chr(0) || lead(key, 1) OVER w || chr(0) || lead(key, 2) OVER w END AS run,
    CASE WHEN words >= 20 THEN 1 WHEN words + lead(words) OVER w >= 20 THEN 2 ELSE 3 END AS len
  FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
later AS (
  SELECT doc_id, n, len FROM (
    SELECT doc_id, n, len, row_number() OVER (PARTITION BY run, len ORDER BY doc_id, n) AS o FROM r WHERE run IS NOT NULL)
  WHERE o > 1),
covered AS (SELECT DISTINCT doc_id, n + x AS n FROM later, range(3) t(x) WHERE x < len),
stretch AS (SELECT c.doc_id, c.n, words, c.n - row_number() OVER (PARTITION BY c.doc_id ORDER BY c.n) AS g FROM covered c JOIN s USING (doc_id, n)),
gone AS (SELECT doc_id, n FROM stretch QUALIFY sum(words) OVER (PARTITION BY doc_id, g) >= 20),
m AS (
  SELECT k.doc_id, k.i, k.piece, s.n IS NOT NULL AS sentence, gone.n IS NOT NULL AS dropped
  FROM k LEFT JOIN s ON k.doc_id = s.doc_id AND k.i = s.i LEFT JOIN gone ON s.doc_id = gone.doc_id AND s.n = gone.n)
SELECT d.doc_id, (count(*) FILTER (WHERE sentence))::BIGINT AS n_sentences,
       (count(*) FILTER (WHERE dropped))::BIGINT AS n_removed,
       sha256(coalesce(string_agg(piece, '' ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM documents d LEFT JOIN m USING (doc_id) GROUP BY d.doc_id
""",
    "op9_quality_rules": rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS filled
  FROM documents),
g AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS p, w FROM d WHERE len(w) >= 5),
grams AS (SELECT doc_id, p, w[p] || chr(32) || w[p+1] || chr(32) || w[p+2] || chr(32) || w[p+3] || chr(32) || w[p+4] AS gram FROM g),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS k FROM grams) WHERE k > 1),
covered AS (SELECT doc_id, count(DISTINCT p + o) AS n FROM twice, range(5) r(o) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, t, len(w)::BIGINT AS n_words,
         length(translate(t, {_WS}, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(filled) - len(list_distinct(filled)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN covered c USING (doc_id)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed
    OR n_symbols * 10 > n_words
    OR (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) * 2 > length(t)
    OR (length(t) - length(translate(t, '!?', ''))) * 2 > n_words
    OR (length(t) - length(translate(t, '0123456789', ''))) * 2 > length(t)
    OR NOT (word_chars BETWEEN 2 * n_words AND 20 * n_words)
    OR (length(t) - length(replace(t, chr(65533), ''))) * 100 > length(t)
    OR len(regexp_extract_all(t, '(\.\.\.|…)[\x20\x09-\x0D]*(\n|$)')) * 10 > 3 * (length(t) - length(replace(t, chr(10), '')) + 1)
    OR len(regexp_extract_all(t, '(^|\n)[\x20\t]*[•●■-]\x20')) * 10 > 9 * (length(t) - length(replace(t, chr(10), '')) + 1)
    OR len(regexp_extract_all(t, '(?i)lorem ipsum|\{{\{{|\}}\}}|javascript:')) * 50 > n_words) AS kept
FROM v
""",
    "op10_line_dedup": rf"""
WITH l AS (
  SELECT doc_id, i, line, translate(trim(line, {_WS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
        FROM documents)),
f AS (SELECT *, length(k) >= 10 AND min(doc_id) OVER (PARTITION BY k) < doc_id AS gone FROM l)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
""",
    "op11_conversation_repair": CONVERSATION_REPAIR,
    "op13_vector_codes": VECTOR_CODES,
}
