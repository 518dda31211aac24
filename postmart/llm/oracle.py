"""DuckDB SQL of the queries that SQL can express, over the same tables."""

OP8 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM p),
b AS (SELECT page_id, payload_bytes, hex, list_aggregate(list_transform(range(0, 8), lambda g: list_aggregate(list_transform(
        [15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            CAST(((CAST('0x' || substr(hex, CAST(5 * g + 1 AS INTEGER), 5) AS BIGINT) >> s) & 31) + 1 AS INTEGER), 1)),
        'string_agg', '')), 'string_agg', '') AS payload_digest FROM d),
o AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS original FROM b)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM o"""

OP12 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
             CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
       AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3"""

# CRC-32 over the bytes of a decimal number: its fixed polynomial, start and final complement.
OP13 = """
WITH own AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos,
                    coalesce(role, '') AS role, coalesce(text, '') AS text
             FROM conversations WHERE conv_id IS NOT NULL),
digits AS (SELECT DISTINCT c, CAST(c AS VARCHAR) AS t FROM own),
codes AS (SELECT c, list_transform(range(1, length(t) + 1), lambda i: ascii(substr(t, CAST(i AS INTEGER), 1))) AS b FROM digits),
convs AS (SELECT c, c - c % 100 AS donor,
                 xor(list_reduce(list_concat([4294967295], b), lambda a, x: list_reduce(
                     list_concat([xor(a, x)], [0, 0, 0, 0, 0, 0, 0, 0]),
                     lambda k, z: xor(k >> 1, CASE WHEN k % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 6 AS h
          FROM codes),
joined AS (SELECT v.c, 0 AS part, o.pos, role, text FROM convs v JOIN own o ON o.c = v.donor AND o.pos < v.h
           UNION ALL SELECT v.c, 1, o.pos, role, text FROM convs v JOIN own o ON o.c = v.c AND o.pos >= v.h),
turns AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS depth, length(text) AS chars,
                 sha256(sha256(role) || sha256(text)) AS turn FROM joined),
paths AS (SELECT c, depth, chars, string_agg(turn, '') OVER (PARTITION BY c ORDER BY depth) AS path,
                 count(*) OVER (PARTITION BY c) AS n FROM turns
          UNION ALL SELECT c, 0, 0, '', (SELECT count(*) FROM turns t WHERE t.c = convs.c) FROM convs),
nodes AS (SELECT path, depth, any_value(chars) AS chars, min(c) AS conv_id, count(*) AS n_convs,
                 coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = depth), '') AS ends
          FROM paths GROUP BY path, depth),
kids AS (SELECT left(path, length(path) - 64) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.path = n.path),
below AS (SELECT left(path, CAST(64 * up AS INTEGER)) AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
                 sum((n_convs - 1) * chars) AS saved_tokens
          FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM full_nodes) GROUP BY 1)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN below b ON b.path = n.path
LEFT JOIN nodes u ON n.depth > 0 AND u.path = left(n.path, length(n.path) - 64)"""

ORACLE = {"op8_revisit_resolution": OP8, "op12_kronecker_negatives": OP12, "op13_prefix_trie": OP13}
