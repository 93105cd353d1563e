"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from salesprep.llm.queries import URL_RULES

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

OP1 = f"""
WITH rules(h, p, v) AS (VALUES {_RULES}),
cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, row_number() OVER () AS n,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
fits AS (
  SELECT n, arg_max(h || p, length(h || p) * 1000 + length(h)) AS rule, arg_max(v, length(h || p) * 1000 + length(h)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (n)
"""

OP8 = """
WITH sized AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
hashed AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM sized),
ranked AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS first FROM hashed)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31))::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM ranked
"""

OP12 = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS x,
    regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u
  FROM documents),
drawn AS (
  SELECT *, len(u) AS n, ('0x' || substr(x, 1, 8))::BIGINT % (len(u) + 1) AS c1, ('0x' || substr(x, 9, 8))::BIGINT % (len(u) + 1) AS c2,
    ('0x' || substr(x, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(x, 25, 8))::BIGINT % 100 AS h4
  FROM cut),
parts AS (
  SELECT *, coalesce(array_to_string(u[1:least(c1, c2)], ''), '') AS p,
    coalesce(array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS m,
    coalesce(array_to_string(u[greatest(c1, c2) + 1:], ''), '') AS s,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 50 THEN 'plain'
      WHEN h4 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""

# crc32 bit by bit, as DuckDB has none; a node's key is its turns' keys one after the other, 64 digits each
OP13 = """
WITH turns AS (
  SELECT conv_id, length(coalesce(text, '')) AS chars, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id AS c, conv_id - conv_id % 100 AS b, (4294967295 - list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, x: list_reduce(list_prepend(xor(a, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda p, q: xor(p >> 1, (p & 1) * 3988292384)))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
sizes AS (SELECT conv_id, count(*) AS size FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT c, i AS d, k, chars FROM ids JOIN turns ON conv_id = b AND i <= h
  UNION ALL
  SELECT c, least(h, coalesce(size, 0)) + i - h, k, chars
  FROM ids JOIN turns ON turns.conv_id = c AND i > h LEFT JOIN sizes ON sizes.conv_id = b),
paths AS (
  SELECT c, d, string_agg(k, '') OVER (PARTITION BY c ORDER BY d) AS k, chars FROM rebuilt
  UNION ALL
  SELECT c, 0, '', 0 FROM ids),
nodes AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM paths GROUP BY k, d),
children AS (SELECT substr(k, 1, 64 * (d - 1)::INT) AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
sized AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (k)),
sums AS (
  SELECT substr(k, 1, 64 * j::INT) AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM sized) GROUP BY 1),
ends AS (SELECT k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM (SELECT c, arg_max(k, d) AS k FROM paths GROUP BY c) GROUP BY k)
SELECT n.conv_id, n.d::BIGINT AS depth, above.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM sized n JOIN sums USING (k) LEFT JOIN ends USING (k) LEFT JOIN nodes above ON n.d > 0 AND above.k = substr(n.k, 1, 64 * (n.d - 1)::INT)
"""

ORACLE = {"op1_url_filter": OP1, "op8_warc": OP8, "op12_fill_in_middle": OP12, "op13_prefix_trie": OP13}
