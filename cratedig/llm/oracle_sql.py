"""What the queries return, in DuckDB SQL, for tables small enough to compare each with each."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT r, i, md5(array_slice(b, i + 1, i + 400)) AS h FROM (SELECT r, b, unnest(range(0, octet_length(b) - 399)) AS i FROM d WHERE octet_length(b) >= 400)),
s AS (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 400, TRUE)::INT AS fresh FROM w JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)),
n AS (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS k FROM s),
spans AS (SELECT r, k, min(i) AS a, max(i) + 400 AS z FROM n GROUP BY r, k),
pieces AS (SELECT r, k, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY k), 0) AS start FROM spans),
cut AS (
  SELECT r, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, max(z) AS rest, string_agg(hex(array_slice(b, start + 1, a)), '' ORDER BY k) AS kept
  FROM pieces JOIN d USING (r) GROUP BY r)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, '') || hex(array_slice(b, coalesce(rest, 0) + 1, octet_length(b))))) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""

OP2 = rf"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT r, doc_id, CASE WHEN len(ws) < 2 THEN ws ELSE list_sort(list_distinct([ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))])) END AS set
  FROM w),
n AS (SELECT row_number() OVER () AS node, set, len(set) AS size, min(doc_id) AS least FROM s WHERE len(set) > 0 GROUP BY set),
e AS (SELECT node, size, unnest(set) AS x FROM n),
p AS (
  SELECT a.node AS a, b.node AS b, a.size AS na, b.size AS nb, count(*) AS common
  FROM e a JOIN e b ON a.x = b.x AND a.node < b.node AND 100 * least(a.size, b.size) >= 80 * greatest(a.size, b.size) GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * common >= 80 * (na + nb - common)),
g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT node, node AS other FROM n UNION SELECT reach.node, g.b FROM reach JOIN g ON reach.other = g.a),
c AS (SELECT reach.node, min(n.least) AS component_id FROM reach JOIN n ON n.node = reach.other GROUP BY reach.node)
SELECT doc_id, coalesce(len(s.set), 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept
FROM s LEFT JOIN n ON n.set = s.set LEFT JOIN c ON c.node = n.node
"""

OP4 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id::VARCHAR AS item, ws, least(10, len(ws)) AS n FROM (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark) WHERE len(ws) > 0),
pattern AS (SELECT DISTINCT item, n, array_to_string(list_slice(ws, p, p + n - 1), ' ') AS w FROM (SELECT item, n, ws, unnest(range(1, len(ws) - n + 2)) AS p FROM i)),
place AS (SELECT r, n, p, array_to_string(list_slice(ws, p, p + n - 1), ' ') AS w FROM (SELECT r, k.n, ws, unnest(range(1, len(ws) - k.n + 2)) AS p FROM d, (SELECT DISTINCT n FROM i) k WHERE len(ws) >= k.n)),
hit AS (SELECT r, item, place.n AS n, p FROM place JOIN pattern ON place.w = pattern.w AND place.n = pattern.n),
words AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + n)) AS at FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS said FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(said, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

#: crc32 of the UTF-8 bytes of ``x``, with the table of ``_CRC_TABLE`` in scope as ``crc.t``.
_CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, octet_length(encode({x}))), lambda i: ('0x' || substr(hex({x}), (2 * i + 1)::BIGINT, 2))::BIGINT)), lambda a, b: xor(crc.t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295::BIGINT)"
_CRC_STEP = "list_reduce(list_concat([i::BIGINT], range(0, 8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)"
_CRC_TABLE = f"crc AS (SELECT list({_CRC_STEP} ORDER BY i) AS t FROM range(0, 256) r(i))"

OP11 = rf"""
WITH {_CRC_TABLE},
w AS (
  SELECT row_number() OVER () AS r, 'd' AS side, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
  UNION ALL SELECT -row_number() OVER (), 't', NULL, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
e AS (SELECT r, side, unnest(ws) AS word FROM w),
b AS (SELECT word, {_CRC.format(x='word')} % 10000 AS bucket FROM (SELECT DISTINCT word FROM e), crc),
c AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t FROM e JOIN b USING (word) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * ((sum(s) OVER ())::DOUBLE + 10000)) / ((s + 1)::DOUBLE * ((sum(t) OVER ())::DOUBLE + 10000))))::BIGINT AS gain FROM c),
m AS (SELECT r, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS mean FROM e JOIN b USING (word) JOIN g USING (bucket) WHERE side = 'd' GROUP BY r),
x AS (
  SELECT doc_id, coalesce(len(ws), 0)::BIGINT AS n_features, coalesce(mean, 0) AS weight,
    coalesce(mean, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296.0)))::BIGINT AS score
  FROM w LEFT JOIN m USING (r) WHERE side = 'd'),
o AS (SELECT doc_id, n_features, weight, score, row_number() OVER (ORDER BY score DESC, doc_id, n_features) AS rank, count(*) OVER () AS n FROM x WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM o
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM x WHERE n_features < 20
"""

OP13 = rf"""
WITH {_CRC_TABLE},
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '') || coalesce(text, ''))) - 1 AS i, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id AS c, count(*) AS n, conv_id - conv_id % 5 AS b FROM o GROUP BY conv_id),
f AS (SELECT x.c, x.n, x.b, h, least(h, coalesce(y.n, 0)) AS m FROM (SELECT *, {_CRC.format(x="c::VARCHAR")} % 9 AS h FROM k, crc) x LEFT JOIN k y ON x.b = y.c),
r AS (
  SELECT c, i - h + m AS i, role, text FROM f JOIN o ON o.conv_id = c WHERE i >= h
  UNION ALL SELECT c, i, role, text FROM f JOIN o ON o.conv_id = b WHERE i < m),
p AS (
  SELECT c, i + 1 AS d, octet_length(encode(text)) AS bytes, md5(string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY i)) AS x FROM r
  UNION ALL SELECT c, 0, 0, '' FROM k),
z AS (SELECT c, max(d) AS d FROM p GROUP BY c),
v AS (
  SELECT p.d, p.x, min(p.c) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes, coalesce(string_agg(p.c::VARCHAR, ',' ORDER BY p.c) FILTER (z.d = p.d), '') AS ends
  FROM p JOIN z ON z.c = p.c GROUP BY p.d, p.x),
u AS (SELECT v.d, v.x, q.x AS parent FROM v JOIN p q ON q.c = v.conv_id AND q.d = v.d - 1),
n AS (SELECT d - 1 AS d, parent AS x, count(*) AS n_children FROM u GROUP BY d, parent),
w AS (SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN n ON n.d = v.d AND n.x = v.x),
s AS (
  SELECT a.d, a.x, sum((w.n_children = 0)::INT)::BIGINT AS n_leaves, sum((w.n_convs - 1) * w.bytes)::BIGINT AS saved_tokens
  FROM w JOIN p a ON a.c = w.conv_id AND a.d <= w.d GROUP BY a.d, a.x)
SELECT w.conv_id, w.d::BIGINT AS depth, e.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, sha256(w.ends) AS ends_sha256
FROM w JOIN s ON s.d = w.d AND s.x = w.x LEFT JOIN u ON u.d = w.d AND u.x = w.x LEFT JOIN v e ON e.d = w.d - 1 AND e.x = u.parent
"""
