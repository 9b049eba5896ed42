"""The SQL of the corpus queries, where SQL can express them."""

from __future__ import annotations

HEAVY_HITTER_DEDUP = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM n
"""


BOUNDARY_CHAIN_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
w AS (SELECT page_id, h, sha1(h) AS d, max(page_id) OVER (PARTITION BY h) AS k FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((('0x' || substr(d, CAST(5 * (j // 4) + 1 AS INTEGER), 5))::BIGINT >> (15 - 5 * (j % 4))) & 31) + 1 AS INTEGER),
    1)), '') AS payload_digest,
  CASE WHEN page_id = k THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> k THEN k END AS refers_to
FROM w
"""

EVENT_SOURCED_CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
escaped AS (
  SELECT *, replace(replace(replace(text, '\', '\b'), '<', '\l'), '#', '\h') AS body,
    replace(replace(replace(replace(role, '\', '\b'), '<', '\l'), '#', '\h'), chr(10), '\n') AS head
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(19 + length(head) + length(body)) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""


BIT_SLICED_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v),
s AS (
  SELECT q.vec_id AS query_id, r.vec_id AS vec_id, CAST(sum(q.x * r.x) AS BIGINT) AS score
  FROM c q JOIN c r ON q.i = r.i AND q.vec_id <> r.vec_id
  WHERE q.vec_id % 20 = 0 GROUP BY ALL)
SELECT query_id, vec_id, score,
  CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""


POINTER_JUMP_PROOFS = """
WITH RECURSIVE
d AS (
  SELECT *,
    xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), CAST(range(8) AS BIGINT[])),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 2 = 0 AS even
  FROM documents),
t AS (
  SELECT doc_id, source,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    text, CASE WHEN even THEN replace(text, chr(10), '') ELSE text END AS other
  FROM d),
h AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(other) || ':' || other, '-')) AS checked
  FROM t),
l AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS s,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n
  FROM h),
below AS (
  SELECT s, 0 AS level, pos, leaf AS hash, n FROM l
  UNION ALL
  SELECT s, level + 1, pos // 3, sha256(string_agg(hash, '' ORDER BY pos)), (n + 2) // 3
  FROM below WHERE n > 1 GROUP BY s, level, pos // 3, n),
ends AS (SELECT s, hash AS subroot FROM below WHERE n = 1),
above AS (
  SELECT 0 AS level, s - 1 AS pos, subroot AS hash, (SELECT count(*) FROM ends) AS n FROM ends
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(hash, '' ORDER BY pos)), (n + 2) // 3
  FROM above WHERE n > 1 GROUP BY level, pos // 3, n),
nodes AS (
  SELECT s, level, pos, hash, CAST(pow(3, level) AS BIGINT) AS width FROM below WHERE n > 1
  UNION ALL
  SELECT e.s, 1000 + a.level, a.pos, a.hash, CAST(pow(3, a.level) AS BIGINT) FROM ends e, above a WHERE a.n > 1),
steps AS (
  SELECT l.s, l.pos, o.level,
    coalesce(string_agg(o.hash, '' ORDER BY o.pos) FILTER (o.pos < (CASE WHEN o.level < 1000 THEN l.pos ELSE l.s - 1 END) // o.width), '') AS before,
    coalesce(string_agg(o.hash, '' ORDER BY o.pos) FILTER (o.pos > (CASE WHEN o.level < 1000 THEN l.pos ELSE l.s - 1 END) // o.width), '') AS after
  FROM l JOIN nodes o ON o.s = l.s AND o.pos // 3 = (CASE WHEN o.level < 1000 THEN l.pos ELSE l.s - 1 END) // o.width // 3
  GROUP BY ALL),
paths AS (
  SELECT s, pos, string_agg(before || after, '' ORDER BY level) AS proof, list(before || '|' || after ORDER BY level) AS path
  FROM steps GROUP BY s, pos),
folded AS (
  SELECT l.*, e.subroot, (SELECT hash FROM above WHERE n = 1) AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
    list_reduce(list_prepend(l.checked, coalesce(p.path, [])),
      lambda x, y: sha256(split_part(y, '|', 1) || x || split_part(y, '|', 2))) AS folded_root
  FROM l JOIN ends e USING (s) LEFT JOIN paths p ON p.s = l.s AND p.pos = l.pos)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""


TOKEN_GROUP_JOIN = r"""
WITH RECURSIVE
w AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS words
  FROM documents),
e AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(words) < 4 THEN [array_to_string(words, ' ')] ELSE
    list_transform(range(1, len(words) - 2), lambda i: array_to_string(list_slice(words, i, i + 3), ' ')) END) AS x
  FROM w WHERE len(words) > 0),
n AS (SELECT r, count(*) AS n FROM e GROUP BY r),
c AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.r <> b.r GROUP BY a.r, b.r),
links AS (
  SELECT a, b FROM c JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (
  SELECT r AS a, r AS b FROM w
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM w LEFT JOIN n USING (r) JOIN reach ON reach.a = w.r JOIN w o ON o.r = reach.b
GROUP BY w.r, w.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_boundary_chain_warc": BOUNDARY_CHAIN_WARC,
        "op6_event_sourced_chat": EVENT_SOURCED_CHAT,
        "op7_bit_sliced_topk": BIT_SLICED_TOPK,
        "op9_heavy_hitter_dedup": HEAVY_HITTER_DEDUP,
        "op12_pointer_jump_proofs": POINTER_JUMP_PROOFS,
        "op13_token_group_join": TOKEN_GROUP_JOIN,
    }
