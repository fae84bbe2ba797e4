"""What the SQL engine says of the operators that SQL can express."""

from __future__ import annotations

# crc32 is not a function of the SQL engine; a table of 256 numbers over the bytes gives it.
CRC = """
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS i))),
bodies AS (
  SELECT doc_id, source, coalesce(text, '') AS x,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b FROM documents),
digests AS (
  SELECT doc_id, source, x, strlen(x) AS bytes,
         xor(list_reduce([4294967295] || b, lambda c, v: xor(c // 256, t[1 + xor(c % 256, v)])), 4294967295)::BIGINT AS crc
  FROM bodies, crc_table)"""

RING = f"""
WITH RECURSIVE {CRC},
rows AS (
  SELECT doc_id, bytes + 8 AS size, crc,
         ('0x' || substr(md5(concat_ws('|', doc_id, crc, bytes + 8)), 1, 13))::BIGINT AS pos FROM digests),
points AS (
  SELECT pos, shard, (row_number() OVER (ORDER BY pos, shard) - 1)::INT AS arc FROM (
    SELECT ('0x' || substr(md5('shard|' || s || '|' || v), 1, 13))::BIGINT AS pos, s::INT AS shard
    FROM range(24) a(s), range(64) b(v))),
placed AS (
  SELECT r.*, coalesce(p.arc, 0) AS arc FROM rows r ASOF LEFT JOIN points p ON r.pos <= p.pos),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY arc ORDER BY pos, doc_id, size, crc) - 1 AS rank FROM placed),
arcs AS (
  SELECT p.arc, p.shard, coalesce(n, 0)::BIGINT AS n FROM points p LEFT JOIN (SELECT arc, count(*) AS n FROM placed GROUP BY 1) USING (arc)),
total AS (SELECT count(*)::BIGINT AS n FROM rows),
fold AS (
  SELECT -1 AS step, list_transform(range(24), lambda s: n // 24 + CASE WHEN s < n % 24 THEN 1 ELSE 0 END) AS room, 0::BIGINT AS queue,
         NULL::INT AS arc, NULL::INT AS shard, 0::BIGINT AS own, 0::BIGINT AS rest, 0::BIGINT AS queued FROM total
  UNION ALL
  SELECT step + 1,
         list_transform(range(24), lambda i: room[i + 1] - CASE WHEN i = s THEN least(room[i + 1], m + queue) ELSE 0 END),
         queue + m - least(room[s + 1], m + queue), a, s, least(room[s + 1], m), m - least(room[s + 1], m),
         least(queue, room[s + 1] - least(room[s + 1], m))
  FROM (SELECT f.step, f.room, f.queue, a.arc AS a, a.shard AS s, CASE WHEN f.step + 1 < 1536 THEN a.n ELSE 0 END AS m
        FROM fold f JOIN arcs a ON a.arc = (f.step + 1) % 1536 WHERE f.step < 3071)),
steps AS (
  SELECT *, sum(rest) OVER (ORDER BY step) - rest AS rest_before, sum(queued) OVER (ORDER BY step) - queued AS queued_before
  FROM fold WHERE step >= 0),
pieces AS (
  SELECT step, arc, 0 AS lo, own AS hi, shard FROM steps WHERE own > 0
  UNION ALL
  SELECT t.step, r.arc, r.own + greatest(r.rest_before, t.queued_before) - r.rest_before,
         r.own + least(r.rest_before + r.rest, t.queued_before + t.queued) - r.rest_before, t.shard
  FROM steps r JOIN steps t ON r.rest > 0 AND t.queued > 0 AND r.rest_before < t.queued_before + t.queued AND t.queued_before < r.rest_before + r.rest),
flow AS (SELECT *, sum(hi - lo) OVER (PARTITION BY shard ORDER BY step, arc, lo) - (hi - lo) AS base FROM pieces)
SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'rows' AS law, shard, (base + rank - lo)::BIGINT AS slot, NULL::INT AS grown_shard
FROM ranked JOIN flow USING (arc) WHERE rank >= lo AND rank < hi
"""

MIX = rf"""
WITH {CRC},
rows AS (
  SELECT doc_id, source, crc, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS size,
         CASE WHEN length(x) > 0 THEN length(translate(x, '!#$%&*+/<=>@[]^_{{|}}~', ''))::DOUBLE / length(x) ELSE 0.0 END AS share,
         ('0x' || substr(md5(concat_ws('|', '11', doc_id, crc)), 1, 13))::BIGINT AS h FROM digests),
keyed AS (SELECT *, -ln((h + 0.5::DOUBLE) / 4503599627370496) / greatest(0.05, share * share) AS key FROM rows),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY 1),
weighed AS (
  SELECT *, ([5.0, 2.0, 1.0])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w, source_size * 3.0::DOUBLE AS top FROM sizes),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(top) OVER (ORDER BY top / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(w) OVER (ORDER BY top / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
cut AS (SELECT arg_min(level, top / w) AS lambda_ FROM levels WHERE top / w > level),
goals AS (
  SELECT source, source_size, CASE WHEN top / w <= level THEN top ELSE w * lambda_ END AS target FROM levels, cut),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM goals),
ahead AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, crc, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM keyed)
SELECT doc_id, a.size::BIGINT AS size, source_size, round(target, 6) AS target,
       (epochs * a.size + greatest(0, least(a.size, floor(target + 0.5)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
FROM ahead a JOIN plan p ON a.source IS NOT DISTINCT FROM p.source
"""

WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, n, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS digest,
    max(page_id) OVER (PARTITION BY h) AS latest FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> latest THEN latest END AS refers_to FROM d
"""

REACH = """
reach AS (
  SELECT a, b FROM linked
  UNION
  SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a)"""

JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
linked AS (SELECT a, b FROM common JOIN sizes m ON m.doc_id = a JOIN sizes k ON k.doc_id = b WHERE 100 * c >= 75 * (m.n + k.n - c)),
{REACH}
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY 1) ON a = d.doc_id
"""

VECTORS = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
u AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
linked AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_dot_product(x.e, y.e) >= 0.9 * x.n * y.n),
{REACH},
low AS (SELECT a, min(b) AS low FROM reach GROUP BY 1),
links AS (SELECT a, count(*) AS n FROM linked GROUP BY 1)
SELECT vec_id, coalesce(links.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id))::BIGINT AS component_id,
       vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM v LEFT JOIN links ON links.a = vec_id LEFT JOIN low ON low.a = vec_id
"""

# Turns are listed by digest; a node is the list of the digests up to its depth.
TRIE = r"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS i))),
turns AS (
  SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
         substr(md5(length(coalesce(role, '')) || '|' || coalesce(role, '') || coalesce(text, '')), 1, 30) AS d
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS nth FROM turns),
sizes AS (SELECT conv_id, count(*) AS n FROM own GROUP BY 1),
plan AS (
  SELECT conv_id, n, conv_id - conv_id % 20 AS base,
         xor(list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT),
                         lambda c, v: xor(c // 256, t[1 + xor(c % 256, v)])), 4294967295) % 4 AS h
  FROM sizes, crc_table),
cut AS (SELECT p.*, least(h, coalesce(s.n, 0)) AS b FROM plan p LEFT JOIN sizes s ON s.conv_id = p.base),
rebuilt AS (
  SELECT conv_id, nth - h + b AS depth, d, words FROM own JOIN cut USING (conv_id) WHERE nth > h
  UNION ALL
  SELECT c.conv_id, nth, d, words FROM cut c JOIN own o ON o.conv_id = c.base WHERE nth <= b),
paths AS (
  SELECT conv_id, depth, words, list(d) OVER (PARTITION BY conv_id ORDER BY depth) AS path,
         count(*) OVER (PARTITION BY conv_id) AS len FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, 0, []::VARCHAR[], (SELECT count(*) FROM rebuilt r WHERE r.conv_id = s.conv_id) FROM sizes s),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = len), '')) AS ends FROM paths GROUP BY 1, 2),
kids AS (SELECT path[1:depth - 1] AS above, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
full_nodes AS (
  SELECT m.*, p.conv_id AS parent_conv_id, coalesce(k.n, 0) AS n_children
  FROM nodes m LEFT JOIN nodes p ON m.depth = p.depth + 1 AND m.path[1:m.depth - 1] = p.path LEFT JOIN kids k ON k.above = m.path),
spread AS (
  SELECT path[1:i] AS top, (n_children = 0)::INT AS leaf, (n_convs - 1) * words AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS i FROM full_nodes)),
sums AS (SELECT top, sum(leaf) AS n_leaves, sum(saved) AS saved FROM spread GROUP BY 1)
SELECT conv_id::BIGINT AS conv_id, depth::BIGINT AS depth, parent_conv_id::BIGINT AS parent_conv_id, n_convs::BIGINT AS n_convs,
       n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, ends AS ends_sha256
FROM full_nodes JOIN sums ON top = path
"""
