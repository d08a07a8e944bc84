"""SQL for those operators that SQL can express."""

from __future__ import annotations

# crc32 of bytes given as hexadecimal text: a table by eight shifts per byte, then one step per byte.
_TABLE = """
crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i))"""


def _crc32(hexadecimal: str) -> str:
    """crc32 of a column of hexadecimal text of even length, with `t` from crc_table in scope."""
    step = f"xor(a >> 8, t[xor(a & 255, ('0x' || {hexadecimal}[2 * b - 1 : 2 * b])::BIGINT) + 1])"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, range(1, length({hexadecimal}) // 2 + 1)), lambda a, b: {step}), 4294967295)")


OP11 = f"""
WITH {_TABLE.strip()},
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, coalesce(text, '') FROM benchmark),
cut AS (
  SELECT side, r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x{{0}}-\\x{{2F}}\\x{{3A}}-\\x{{60}}\\x{{7B}}-\\x{{7F}}]+') AS w FROM texts),
grams AS (
  SELECT side, r, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT side, r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM cut, (SELECT unnest([1, 2, 3]) AS n))),
counted AS (SELECT side, r, g, count(*) AS c FROM grams GROUP BY ALL),
crcs AS (SELECT g, {_crc32('h')} % 10000 AS bucket FROM (SELECT g, hex(encode(g)) AS h FROM (SELECT DISTINCT g FROM counted)), crc_table),
bucketed AS (SELECT side, r, bucket, sum(c) AS c FROM counted JOIN crcs USING (g) GROUP BY ALL),
sums AS (
  SELECT bucket, coalesce(sum(c) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(c) FILTER (side = 'b'), 0)::DOUBLE AS t
  FROM bucketed GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (sa + 10000)) / ((s + 1) * (ta + 10000))))::BIGINT AS gain
  FROM sums, (SELECT sum(s) AS sa, sum(t) AS ta FROM sums)),
weighed AS (
  SELECT r, sum(c)::BIGINT AS n_features, sum(c * gain)::BIGINT AS weight FROM bucketed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS eligible,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM cut LEFT JOIN weighed USING (r) WHERE side = 'd'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id NULLS FIRST) AS k,
    5 * count(*) FILTER (eligible) OVER () // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND k <= drawn THEN k END AS rank FROM ranked
"""

OP13 = f"""
WITH {_TABLE.strip()},
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32('x')} % 6 AS h
  FROM (SELECT DISTINCT conv_id, hex(encode(conv_id::VARCHAR)) AS x FROM turns), crc_table),
taken AS (
  SELECT c.conv_id, 0 AS part, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
  UNION ALL SELECT c.conv_id, 1, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h),
rebuilt AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth FROM taken),
lists AS (
  SELECT conv_id, coalesce(list(sha256(length(role) || ':' || role || ':' || text) ORDER BY depth) FILTER (depth IS NOT NULL), []) AS l,
    coalesce(list(length(text) ORDER BY depth) FILTER (depth IS NOT NULL), []) AS chars
  FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
rows AS (
  SELECT conv_id, d AS depth, len(l) AS turns, l[1:d] AS node, CASE WHEN d > 0 THEN l[1:d - 1] END AS parent,
    CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars
  FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM lists)),
nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    max(turns) = any_value(depth) AS leaf, (count(*) - 1) * any_value(chars) AS spared,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = turns), '')) AS ends_sha256
  FROM rows GROUP BY node),
below AS (
  SELECT top, sum(leaf::INT)::BIGINT AS n_leaves, sum(spared)::BIGINT AS saved_tokens
  FROM (SELECT node[1:unnest(range(0, depth + 1))] AS top, leaf, spared FROM nodes) GROUP BY top),
families AS (SELECT parent AS of, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(f.n_children, 0) AS n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.top = n.node LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN families f ON f.of = n.node
"""
