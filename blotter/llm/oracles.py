"""DuckDB SQL of the operators whose results SQL can express."""

from __future__ import annotations

# op8: the added conversation, the turns in order, digests, and the length of the default template's output.
CHAT = r"""
WITH hard AS (SELECT '\### Assistant: </turn> ok' AS t),
rows_ AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', t FROM hard UNION ALL SELECT -7, 1, 'assistant', t FROM hard),
sized AS (
  SELECT *, 4 + 2 + 8 + length(regexp_replace(role, '(\\|###|</turn>|: )', '\\\1', 'g'))
              + length(regexp_replace(text, '(\\|###|</turn>|: )', '\\\1', 'g')) AS chars FROM rows_),
told AS (
  SELECT conv_id, COUNT(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         SUM(chars) AS chars
  FROM sized GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM told
"""

# op10: SHA-1 in base 32 (five bits a letter); the largest page_id of a payload is its response.
WARC = """
WITH p AS (SELECT page_id, COALESCE(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS n, CAST(unhex(sha1(html)) AS BIT)::VARCHAR AS bits,
             MAX(page_id) OVER (PARTITION BY html) AS lead FROM p)
SELECT CAST(page_id AS BIGINT) AS page_id, CAST(n AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(list_sum(list_transform(range(0, 5), lambda j: CAST(substr(bits, i * 5 + j + 1, 1) AS INTEGER) * CAST(pow(2, 4 - j) AS INTEGER))) AS INTEGER) + 1, 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> lead THEN lead END AS refers_to
FROM d
"""

# op2: every diagonal on which an item's words meet a document's, scored as a local alignment (match +1, other word -1).
LEAKS = r"""
WITH dw AS (
  SELECT doc_id, th, w, pos - 1 AS pos FROM (
    SELECT doc_id, th, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS pos FROM (
      SELECT doc_id, row_number() OVER () AS th,
             list_filter(string_split_regex(lower(COALESCE(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws FROM documents))),
iw AS (
  SELECT item_id, n, w, pos - 1 AS place FROM (
    SELECT item_id, len(ws) AS n, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS pos FROM (
      SELECT item_id, list_filter(string_split_regex(lower(COALESCE(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws FROM benchmark))),
met AS (
  SELECT th, ANY_VALUE(doc_id) AS doc_id, item_id, pos - place AS shift, MAX(n) AS n, COUNT(*) AS matched, list_sort(list(place)) AS places
  FROM dw JOIN iw USING (w) GROUP BY th, item_id, pos - place
  HAVING COUNT(*) >= LEAST(13, CEIL(0.8 * MAX(n)))),
steps AS (SELECT *, unnest(places) AS j, unnest(range(1, len(places) + 1)) AS k FROM met),
runs AS (
  SELECT th, doc_id, item_id, shift, n, matched,
         2 * k - j - 1 - MIN(2 * (k - 1) - j) OVER (PARTITION BY th, item_id, shift ORDER BY k) AS score FROM steps),
best AS (SELECT th, doc_id, item_id, n, MAX(matched) AS matched, MAX(score) AS score FROM runs GROUP BY th, doc_id, item_id, n)
SELECT doc_id, item_id, CAST(MAX(n) AS BIGINT) AS n_item_words, CAST(MAX(matched) AS BIGINT) AS n_matched, CAST(MAX(score) AS BIGINT) AS score
FROM best WHERE score >= LEAST(13, CEIL(0.8 * n)) GROUP BY doc_id, item_id
"""

# op11: leaves in order, levels of three, each leaf's siblings, and the path folded again; CRC-32 bit by bit.
MERKLE = r"""
WITH RECURSIVE parity AS (
  SELECT *, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
              lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda c, e: CASE WHEN e < 0 THEN xor(c >> 1, 3988292384::BIGINT * (c & 1)) ELSE xor(c, e) END) AS crc FROM documents),
fields AS (
  SELECT doc_id, source, xor(crc, 4294967295::BIGINT) % 2 = 0 AS even,
         COALESCE(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || COALESCE(strlen(source) || ':' || source, '-')
           || COALESCE(strlen(lang) || ':' || lang, '-') || COALESCE(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         text, replace(text, chr(10), '') AS cut FROM parity),
leaves AS (
  SELECT doc_id, source, sha256(head || COALESCE(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN even THEN sha256(head || COALESCE(strlen(cut) || ':' || cut, '-')) END AS told FROM fields),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER () AS rid,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, COUNT(*) OVER (PARTITION BY source) AS n FROM leaves),
nodes AS (
  SELECT tree, 0 AS level, pos AS idx, leaf AS h, n FROM placed
  UNION ALL SELECT tree, level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 3, n),
tops AS (
  SELECT 0 AS level, tree AS idx, h, (SELECT COUNT(DISTINCT tree) FROM placed) AS n FROM nodes WHERE n = 1
  UNION ALL SELECT level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM tops WHERE n > 1 GROUP BY level, idx // 3, n),
steps AS (
  SELECT p.rid, s.level, s.idx, s.h, p.pos // CAST(pow(3, s.level) AS BIGINT) AS own FROM placed p
    JOIN nodes s ON s.tree = p.tree AND s.n > 1 AND s.idx // 3 = p.pos // CAST(pow(3, s.level + 1) AS BIGINT)
  UNION ALL
  SELECT p.rid, 1000 + s.level, s.idx, s.h, p.tree // CAST(pow(3, s.level) AS BIGINT) FROM placed p
    JOIN tops s ON s.n > 1 AND s.idx // 3 = p.tree // CAST(pow(3, s.level + 1) AS BIGINT)),
sides AS (
  SELECT rid, level, COALESCE(string_agg(h, '' ORDER BY idx) FILTER (idx < own), '') AS l, COALESCE(string_agg(h, '' ORDER BY idx) FILTER (idx > own), '') AS r
  FROM steps GROUP BY rid, level),
paths AS (SELECT rid, string_agg(l || r, '' ORDER BY level) AS proof, list(l || '|' || r ORDER BY level) AS path FROM sides GROUP BY rid),
folded AS (
  SELECT p.doc_id, p.leaf, s.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root, sha256(COALESCE(t.proof, '')) AS proof_sha256,
         list_reduce(list_prepend(COALESCE(p.told, p.leaf), COALESCE(t.path, [])),
                     lambda a, e: sha256(split_part(e, '|', 1) || a || split_part(e, '|', 2))) AS folded_root
  FROM placed p JOIN nodes s ON s.tree = p.tree AND s.n = 1 LEFT JOIN paths t USING (rid))
SELECT *, folded_root = root AS verified FROM folded
"""

# op12: every phrase of one to four words counted, cuts in 128-bit integers.
PHRASES = r"""
WITH pieces AS (
  SELECT COALESCE(lang, 'und') AS lang, unnest(string_split_regex(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
grams AS (SELECT lang, m, ws[i:i + m - 1] AS p FROM (
  SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM worded, (VALUES (1), (2), (3), (4)) sizes(m) WHERE len(ws) >= m)),
f AS (SELECT lang, m, p, COUNT(*) AS a FROM grams GROUP BY lang, m, p),
totals AS (SELECT lang, SUM(a) AS n FROM f WHERE m = 1 GROUP BY lang),
cands AS (SELECT * FROM f WHERE m > 1 AND a >= 30),
inner_ AS (
  SELECT lang, p[i:i + k - 1] AS p, MAX(a) AS around FROM (
    SELECT lang, p, m, a, k, unnest(range(1, m - k + 2)) AS i FROM cands, (VALUES (2), (3)) parts(k) WHERE k < m) GROUP BY lang, p[i:i + k - 1]),
kept AS (SELECT c.* FROM cands c LEFT JOIN inner_ s USING (lang, p) WHERE s.around IS NULL OR 100 * s.around < 80 * c.a),
cuts AS (SELECT lang, p, m, a, unnest(range(1, m)) AS k FROM kept),
scored AS (
  SELECT c.lang, c.p, c.a, c.k, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a) // (x.a + y.a) AS score FROM cuts c
    JOIN f x ON x.lang = c.lang AND x.p = c.p[1:c.k] JOIN f y ON y.lang = c.lang AND y.p = c.p[c.k + 1:c.m]),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (SELECT *, array_to_string(p, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM best)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

SQL = {"op2_decontamination": LEAKS, "op8_chat_format": CHAT, "op10_warc": WARC, "op11_merkle_manifest": MERKLE, "op12_collocations": PHRASES}
