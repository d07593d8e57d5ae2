"""The corpus queries as SQL over the same tables, written from their definitions."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# crc32 (reflected polynomial 0xEDB88320) from a table of 256 remainders that a recursion makes
ORACLES["op1_interleaved_shards"] = """
WITH RECURSIVE remainders(i, k, c) AS (
  SELECT range, 0, range::BIGINT FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM remainders WHERE k < 8
),
remainder AS (SELECT list(c ORDER BY i) AS t FROM remainders WHERE k = 8),
sized AS (
  SELECT doc_id, source, coalesce(text, '') AS body, strlen(coalesce(text, ''))::BIGINT + 1 AS size,
    md5('0|' || doc_id::VARCHAR) AS mixed
  FROM documents
),
summed AS (
  SELECT doc_id, source, size, mixed, xor(4294967295, list_reduce(
    list_transform(range(strlen(body)), lambda i: ('0x' || substr(hex(encode(body)), 2 * i::INT + 1, 2))::BIGINT),
    lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1]), 4294967295)) AS text_crc32
  FROM sized, remainder
),
ranked AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY mixed, doc_id) - 1)
    / (2.0::DOUBLE * count(*) OVER (PARTITION BY source)) AS frac
  FROM summed
),
placed AS (
  SELECT *, row_number() OVER (ORDER BY frac, coalesce('=' || source, ''), mixed, doc_id) - 1 AS place,
    count(*) OVER () AS n
  FROM ranked
),
cut AS (SELECT *, (place * 16) // n AS s FROM placed)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, s::INT AS shard,
  (place - (s * n + 15) // 16)::BIGINT AS slot, NULL::INT AS grown_shard, source
FROM cut
"""

ORACLES["op4_url_filter"] = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN url IS NOT NULL AND strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages
),
split AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
),
rules(h, p, action) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
won AS (
  SELECT page_id, host, path, max({'h': length(h), 'p': length(p), 'rule': h || p, 'action': action}) AS best
  FROM split JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id, host, path
)
SELECT s.page_id, s.host, s.path, w.best.rule AS rule, coalesce(w.best.action, 'allow') AS verdict
FROM split s LEFT JOIN won w ON s.page_id = w.page_id
"""

ORACLES["op10_benchmark_decontamination"] = r"""
WITH worded AS (
  SELECT 'd' AS kind, doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT 'i', item_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda w: w <> '')
  FROM benchmark WHERE text IS NOT NULL
),
starts AS (
  SELECT kind, id, w, unnest(range(greatest(len(w) - 4, 1))) AS s FROM worded WHERE len(w) > 0
),
shingles AS (SELECT DISTINCT kind, id, array_to_string(w[s + 1 : s + 5], ' ') AS shingle FROM starts),
sizes AS (SELECT id, count(*) AS n_item FROM shingles WHERE kind = 'i' GROUP BY id),
shared AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared
  FROM shingles d JOIN shingles i ON d.kind = 'd' AND i.kind = 'i' AND d.shingle = i.shingle
  GROUP BY d.id, i.id
)
SELECT doc_id, item_id, n_item, n_shared, n_shared::DOUBLE / n_item AS containment
FROM shared JOIN sizes ON item_id = id WHERE n_shared * 100 >= n_item * 80
"""

ORACLES["op8_warc_round_trip"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
g AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS f FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN f IS NOT NULL AND f <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f <> page_id THEN f END AS refers_to
FROM g
"""

ORACLES["op2_ngram_jaccard_join"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[s + 1 : s + 5], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS s FROM worded WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT a, b FROM met JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * m >= 80 * (x.n + y.n - m)
),
reached(a, b) AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(min(b), d.doc_id))::BIGINT AS component_id
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id LEFT JOIN reached r ON d.doc_id = r.a
GROUP BY d.doc_id, n
"""

# runs as islands of equal words at one distance; the loops that a tenth of the texts get are planted first
ORACLES["op12_periodic_runs"] = r"""
WITH RECURSIVE remainders(i, k, c) AS (
  SELECT range, 0, range::BIGINT FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM remainders WHERE k < 8
),
remainder AS (SELECT list(c ORDER BY i) AS t FROM remainders WHERE k = 8),
said AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
    xor(4294967295, list_reduce(
      list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i::INT + 1, 1))::BIGINT),
      lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1]), 4294967295)) AS h
  FROM documents, remainder
),
drawn AS (
  SELECT doc_id, w, len(w) AS n, h, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) ELSE 0 END AS a FROM said
),
altered AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END])
    ELSE w END AS w
  FROM drawn
),
placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM altered),
agreeing AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i FROM placed x JOIN placed y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i
),
islands AS (
  SELECT doc_id, q, min(i) AS s, count(*) + q AS len
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM agreeing)
  GROUP BY doc_id, q, g HAVING count(*) >= greatest(q, 12 - q)
),
found AS (SELECT doc_id, s, len, min(q) AS q FROM islands GROUP BY doc_id, s, len),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS runs,
    first({'s': s, 'len': len, 'q': q} ORDER BY len DESC, s, q) AS top
  FROM found GROUP BY doc_id
),
kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS body FROM placed p
  WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.doc_id = p.doc_id AND p.i >= f.s + f.q AND p.i < f.s + f.len)
  GROUP BY p.doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, l.top.s::BIGINT AS start, l.top.len::BIGINT AS length,
  l.top.q::BIGINT AS period, (1000 * l.top.len // l.top.q)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
  sha256(coalesce(body, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed l ON d.doc_id = l.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

ORACLES["op13_exact_top_k"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, r::INT AS rank, vec_id, score FROM ranked WHERE r <= 5
"""

# a level's pairs are joined to their parents by halving places; every proof is climbed level by level
ORACLES["op11_merkle_manifest"] = """
WITH RECURSIVE remainders(i, k, c) AS (
  SELECT range, 0, range::BIGINT FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM remainders WHERE k < 8
),
remainder AS (SELECT list(c ORDER BY i) AS t FROM remainders WHERE k = 8),
said AS (
  SELECT doc_id, lang, n_chars, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(4294967295, list_reduce(
      list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i::INT + 1, 1))::BIGINT),
      lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1]), 4294967295)) % 7 = 0 AS tampered
  FROM documents, remainder
),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) AS bent, tampered
  FROM said
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS pos,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
  FROM leaves
),
low(tree, level, pos, digest, n) AS (
  SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2
  FROM low WHERE n > 1 GROUP BY tree, level, pos // 2, n
),
high(level, pos, digest, n) AS (
  SELECT 0, tree, digest, count(*) OVER () FROM low WHERE n = 1
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2 FROM high WHERE n > 1
  GROUP BY level, pos // 2, n
),
nodes AS (
  SELECT tree, level, pos, digest, n FROM low UNION ALL SELECT -1, level, pos, digest, n FROM high
),
climb(doc_id, leaf, own, tree, level, pos, n, digest, proof) AS (
  SELECT doc_id, leaf, tree, tree, 0, pos, count(*) OVER (PARTITION BY tree), CASE WHEN tampered THEN bent ELSE leaf END, '' FROM placed
  UNION ALL
  SELECT c.doc_id, c.leaf, c.own, CASE WHEN c.n > 1 THEN c.tree ELSE -1 END, CASE WHEN c.n > 1 THEN c.level + 1 ELSE 0 END,
    CASE WHEN c.n > 1 THEN c.pos // 2 ELSE c.tree END, CASE WHEN c.n > 1 THEN (c.n + 1) // 2 ELSE (SELECT count(*) FROM high WHERE level = 0) END,
    CASE WHEN c.n = 1 THEN c.digest WHEN c.pos % 2 = 1 THEN sha256(s.digest || c.digest)
      ELSE sha256(c.digest || coalesce(s.digest, '')) END,
    c.proof || CASE WHEN c.n > 1 THEN coalesce(s.digest, '') ELSE '' END
  FROM climb c LEFT JOIN nodes s ON c.tree = s.tree AND c.level = s.level AND s.pos = xor(c.pos, 1)
  WHERE c.n > 1 OR c.tree >= 0
)
SELECT c.doc_id, c.leaf, l.digest AS subroot, h.digest AS root, sha256(c.proof) AS proof_sha256, c.digest AS folded_root,
  c.digest = h.digest AS verified
FROM climb c JOIN low l ON c.own = l.tree AND l.n = 1 JOIN high h ON h.n = 1
WHERE c.tree = -1 AND c.n = 1
"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
