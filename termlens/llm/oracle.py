"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

OP2 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), n AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    4 + 2 + 8 + length(role) + length(text)
      + length(role) - length(replace(replace(replace(replace(role, '\', ''), '#', ''), '<', ''), ':', ''))
      + length(text) - length(replace(replace(replace(text, '\', ''), '#', ''), '<', '')) AS chars
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), p AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM n
)
SELECT conv_id, max(n)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' OR i = n THEN upto ELSE 0 END)::BIGINT AS formatted_chars,
  count(*) FILTER (role = 'assistant')::BIGINT AS n_targets
FROM p GROUP BY conv_id
"""

OP5 = r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), c AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), h AS (
  SELECT page_id, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM c
), r(verdict, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), m AS (
  SELECT page_id, host, path, rhost || rpath AS rule, verdict
  FROM h LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule,
  coalesce(arg_max(verdict, length(rule)), 'allow') AS verdict, count(rule)::INTEGER AS n_matched
FROM m GROUP BY page_id, host, path
"""

OP3 = r"""
WITH d AS (
  SELECT doc_id, hex(coalesce(text, '')) AS h, length(hex(coalesce(text, ''))) // 2 AS n FROM documents
), w AS (
  SELECT doc_id, unnest(range(n - 99)) AS p, h FROM d WHERE n >= 100
), k AS (
  SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS s FROM w
), r AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS nth FROM k) WHERE nth > 1
), f AS (
  SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS new FROM r
), g AS (
  SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM f
), spans AS (
  SELECT doc_id, span, min(p) AS a, max(p) + 100 AS b FROM g GROUP BY doc_id, span
), parts AS (
  SELECT doc_id, span, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY span) AS since FROM spans
), kept AS (
  SELECT p.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
    string_agg(substr(d.h, 2 * since + 1, 2 * (a - since)), '' ORDER BY span) || substr(any_value(d.h), 2 * max(b) + 1) AS h
  FROM parts p JOIN d USING (doc_id) GROUP BY p.doc_id
)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
  coalesce(k.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id)
"""

OP6 = r"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""

OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), t AS (
  SELECT r, lang, source, unnest(terms) AS term FROM d
), k AS (
  SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), v AS (
  SELECT lang, count(*) AS width, sum(n)::BIGINT AS total FROM k GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY lang, source, term
), gn AS (
  SELECT lang, source, coalesce(sum(n), 0)::BIGINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source
), p AS (
  SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000 * (coalesce(c.n, 0) + 1) // (gn.total + v.width) AS p,
    1 + 1000000000 * (k.n + 1) // (v.total + v.width) AS q
  FROM gn JOIN v USING (lang) JOIN k USING (lang)
  LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term
), s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), u AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
WHERE part = 'pair' OR rank <= 200
"""

OP12 = r"""
WITH o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS steps
), c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)),
      lambda x, y: xor(x >> 8, steps[(xor(x, y) & 255) + 1]))) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM o), crc
), lent AS (
  SELECT c.conv_id, o.i AS pos, o.role, o.text FROM c JOIN o ON o.conv_id = c.base AND o.i <= c.h
), k AS (
  SELECT c.conv_id, c.h, count(l.pos) AS k FROM c LEFT JOIN lent l USING (conv_id) GROUP BY c.conv_id, c.h
), r AS (
  SELECT * FROM lent
  UNION ALL SELECT conv_id, k + i - h, role, text FROM o JOIN k USING (conv_id) WHERE i > h
), pre AS (
  SELECT conv_id, pos AS depth,
    md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY pos)) AS key,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM r
  UNION ALL SELECT conv_id, 0, '', 0 FROM c
), l AS (
  SELECT conv_id, max(depth) AS depth FROM pre GROUP BY conv_id
), n AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words FROM pre GROUP BY depth, key
), e AS (
  SELECT depth, key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
  FROM pre JOIN l USING (conv_id, depth) GROUP BY depth, key
), p AS (
  SELECT n.*, u.key AS up FROM n LEFT JOIN pre u ON u.conv_id = n.conv_id AND u.depth = n.depth - 1
), kids AS (
  SELECT depth - 1 AS depth, up AS key, count(*) AS n FROM p WHERE depth > 0 GROUP BY ALL
), own AS (
  SELECT p.*, coalesce(kids.n, 0) AS n_children FROM p LEFT JOIN kids USING (depth, key)
), s AS (
  SELECT a.depth, a.key, count(*) FILTER (own.n_children = 0) AS n_leaves, sum((own.n_convs - 1) * own.words) AS saved_tokens
  FROM own JOIN pre a ON a.conv_id = own.conv_id AND a.depth <= own.depth GROUP BY a.depth, a.key
)
SELECT own.conv_id, own.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, own.n_convs, own.n_children::BIGINT AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM own JOIN s USING (depth, key) LEFT JOIN e USING (depth, key) LEFT JOIN n q ON q.depth = own.depth - 1 AND q.key = own.up
"""

ORACLE = {"op2_chat_formatting": OP2, "op3_suffix_dedup": OP3, "op5_url_filter": OP5, "op6_exact_topk": OP6,
          "op11_source_divergence": OP11,
          "op12_prefix_trie": OP12}
