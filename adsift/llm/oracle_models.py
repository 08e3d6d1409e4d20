"""DuckDB SQL for conversation repair and vector codes, written independently of the operators."""

from __future__ import annotations


def crc32(text: str) -> str:
    """SQL for the crc32 of an ASCII string, bit by bit."""
    return (f"list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)), "
            "lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda i: i::BIGINT)), "
            "lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END))")


_SPACES = r"[\x20\x09-\x0D]"

#: States: 0 nothing read, 1 after s, 2 after an open u, 3 after a pair. What up to two inserts reach from each.
CONVERSATION_REPAIR = rf"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor({crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")}, 4294967295::BIGINT) % 20 AS kind
  FROM conversations),
rws AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM src, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
num AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         regexp_replace(text, '{_SPACES}+$', '') AS filled FROM rws),
flagged AS (
  SELECT conv_id, turn, role, text, i, filled = '' AS blank,
         filled <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
         filled <> '' AND NOT regexp_matches(filled, '[.!?]$') AS open_end,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM num),
faults AS (SELECT *, open_end AND NOT duplicate AS truncated FROM flagged),
ins(a, b, cost, e) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'),
  (1, 2, 3, 'I'), (1, 3, 6, 'II'), (2, 3, 3, 'I'), (3, 2, 3, 'I')),
nxt(a, letter, b) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
edits AS (
  SELECT f.conv_id, f.i, s.a, s.a AS b, 4 AS cost, 'D' AS e FROM faults f, range(4) s(a)
  UNION ALL SELECT conv_id, i, a, b, 3 * truncated::INT, 'K' FROM faults JOIN nxt ON letter = left(role, 1) WHERE NOT blank AND NOT duplicate
  UNION ALL SELECT conv_id, i, a, b, 3 + 3 * truncated::INT, 'R' FROM faults, nxt WHERE letter <> 's' AND NOT blank AND NOT duplicate),
dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, {{'cost': 0::BIGINT, 'audit': ''}} AS best FROM rws
  UNION ALL
  SELECT d.conv_id, d.i + 1, t.b::INT, min({{'cost': d.best.cost + n.cost + t.cost, 'audit': d.best.audit || n.e || t.e}})
  FROM dp d JOIN ins n ON n.a = d.state JOIN edits t ON t.conv_id IS NOT DISTINCT FROM d.conv_id AND t.i = d.i + 1 AND t.a = n.b
  GROUP BY d.conv_id, d.i, t.b),
last AS (SELECT conv_id, max(i) AS n FROM num GROUP BY conv_id),
best AS (
  SELECT d.conv_id, min({{'cost': d.best.cost + n.cost, 'audit': d.best.audit || n.e}}) AS best
  FROM dp d JOIN last l ON l.conv_id IS NOT DISTINCT FROM d.conv_id AND l.n = d.i JOIN ins n ON n.a = d.state
  WHERE n.b IN (0, 3) GROUP BY d.conv_id),
letters AS (
  SELECT conv_id, unnest(string_split(best.audit, '')) AS e, unnest(range(1, len(best.audit) + 1)) AS k FROM best WHERE best.audit <> ''),
placed AS (
  SELECT *, count(*) FILTER (WHERE e <> 'I') OVER w AS i, count(*) FILTER (WHERE e <> 'D') OVER w AS p,
         count(*) FILTER (WHERE e <> 'D') OVER (PARTITION BY conv_id) AS m
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
repaired AS (
  SELECT q.conv_id, sha256(string_agg(
      CASE WHEN e = 'K' THEN f.role WHEN (m - p) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
      CASE WHEN e = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY p)) AS digest
  FROM placed q LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM q.conv_id AND f.i = q.i
  WHERE e <> 'D' GROUP BY q.conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.best.cost, 0)::BIGINT AS cost,
       coalesce(b.best.audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""

_NEAREST = """SELECT x.vec_id, x.p, min(list_sum(list_transform(range(1, len(x.v) + 1), lambda j: (x.v[j] - c.v[j]) * (x.v[j] - c.v[j]))) * 64 + c.e) AS m
  FROM cut x JOIN {books} c ON c.p = x.p GROUP BY x.vec_id, x.p"""


def _round(n: int) -> str:
    """Assignment to books<n> and their replacement, books<n + 1>."""
    return f"""near{n} AS MATERIALIZED ({_NEAREST.format(books=f"books{n}")}),
sums{n} AS (
  SELECT p, e, j, sum(y)::BIGINT AS s, count(*) AS n FROM (
    SELECT x.p, (a.m % 64)::BIGINT AS e, unnest(x.v) AS y, unnest(range(1, len(x.v) + 1)) AS j FROM cut x JOIN near{n} a USING (vec_id, p))
  GROUP BY p, e, j),
means{n} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM sums{n} GROUP BY p, e),
books{n + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM books{n} b LEFT JOIN means{n} m ON m.p = b.p AND m.e = b.e),"""


VECTOR_CODES = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
cut AS MATERIALIZED (SELECT vec_id, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS v FROM kept, range(16) r(p)),
firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)),
books0 AS MATERIALIZED (SELECT c.p, f.e, c.v FROM cut c JOIN firsts f USING (vec_id)),
{_round(0)}
{_round(1)}
final AS ({_NEAREST.format(books="books2")}),
coded AS (
  SELECT vec_id, string_agg(printf('%02x', (m % 64)::INT), '' ORDER BY p) AS code, sum(m // 64)::BIGINT AS error FROM final GROUP BY vec_id)
SELECT c.vec_id, c.code, c.error, sum(c.error) OVER (PARTITION BY k.label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM books2) AS codebooks_sha256
FROM coded c JOIN kept k USING (vec_id)
"""
