"""DuckDB SQL for the rows of the operators that SQL can express, over the same views."""

WORD = r"[^\x20\x09-\x0D]+"

# crc32 of ASCII strings: a table of 256 entries by eight shifts, then one byte a step
CRC = """
bit_steps(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i) UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bit_steps WHERE k < 8),
crc_table AS (SELECT i, c AS v FROM bit_steps WHERE k = 8),
crc_steps(s, p, c) AS (
  SELECT s, 0, 4294967295::BIGINT FROM crc_input UNION ALL
  SELECT s, p + 1, xor(c >> 8, v) FROM crc_steps JOIN crc_table ON i = xor(c & 255, ascii(s[p + 1])) WHERE p < length(s)),
crc AS (SELECT s, xor(c, 4294967295) AS crc FROM crc_steps WHERE p = length(s))"""

OP3 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 20"""

OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
win AS (SELECT r, doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM d WHERE len(w) >= 50 AND doc_id IS NOT NULL),
h AS (SELECT r, doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM win),
first AS (SELECT s, min(doc_id) AS f FROM h GROUP BY s),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS p FROM h JOIN first USING (s) WHERE f < doc_id),
words AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (r, p) GROUP BY r),
n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN n USING (r)"""

OP8 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '{WORD}') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM (
          SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
hit AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM hit JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a),
low AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(({0})::VARCHAR) || ':' || {0} END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"

OP11 = f"""
WITH RECURSIVE crc_input AS (SELECT DISTINCT doc_id::VARCHAR AS s FROM documents WHERE doc_id IS NOT NULL), {CRC},
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_LEAF.format(n="n_chars")} AS leaf,
         CASE WHEN crc % 7 = 0 THEN {_LEAF.format(n="n_chars + 1")} END AS other,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM documents LEFT JOIN crc ON s = doc_id::VARCHAR),
up(g, lv, i, h, m) AS (
  SELECT g, 0, i, leaf, count(*) OVER (PARTITION BY g) FROM leaves UNION ALL
  SELECT g, lv + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(m) + 1) // 2 FROM up WHERE m > 1 GROUP BY g, lv, i // 2),
top AS (SELECT g, h, lv, row_number() OVER (ORDER BY g) - 1 AS place FROM up WHERE m = 1),
up2(lv, i, h, m) AS (
  SELECT 0, place, h, count(*) OVER () FROM top UNION ALL
  SELECT lv + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(m) + 1) // 2 FROM up2 WHERE m > 1 GROUP BY lv, i // 2),
root AS (SELECT h AS root FROM up2 WHERE m = 1),
steps AS (
  SELECT l.g, l.i, n.lv, s.h, s.i < (l.i >> n.lv) AS is_left
  FROM leaves l JOIN (SELECT DISTINCT g, lv FROM up WHERE m > 1) n USING (g)
  LEFT JOIN up s ON s.g = l.g AND s.lv = n.lv AND s.i = xor(l.i >> n.lv, 1)
  UNION ALL
  SELECT l.g, l.i, t.lv + n.lv, s.h, s.i < (t.place >> n.lv)
  FROM leaves l JOIN top t USING (g), (SELECT DISTINCT lv FROM up2 WHERE m > 1) n
  LEFT JOIN up2 s ON s.lv = n.lv AND s.i = xor(t.place >> n.lv, 1)),
proofs AS (SELECT g, i, count(*) AS height, coalesce(string_agg(h, '' ORDER BY lv), '') AS p FROM steps GROUP BY g, i),
folds(g, i, lv, h) AS (
  SELECT g, i, 0, coalesce(other, leaf) FROM leaves UNION ALL
  SELECT g, i, f.lv + 1, sha256(CASE WHEN s.h IS NULL THEN f.h WHEN is_left THEN s.h || f.h ELSE f.h || s.h END)
  FROM folds f JOIN steps s USING (g, i, lv))
SELECT doc_id, leaf, top.h AS subroot, root, sha256(coalesce(p, '')) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM leaves l JOIN top USING (g) CROSS JOIN root LEFT JOIN proofs USING (g, i)
JOIN folds f ON f.g = l.g AND f.i = l.i AND f.lv = coalesce(height, 0)"""

# states: 0 nothing kept, 1 after system, 2 after user, 3 after assistant; up to two insertions stand before an edit
OP13 = f"""
WITH RECURSIVE crc_input AS (
  SELECT DISTINCT coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations), {CRC},
src AS (
  SELECT coalesce('=' || conv_id, '') AS c, conv_id, turn, crc % 20 AS k, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text
  FROM conversations JOIN crc ON s = coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')),
bad AS (
  SELECT c, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM src, range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) r(copy)),
seq AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i,
               row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST) AS nth,
               regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS tail FROM bad),
rows AS (SELECT *, CASE WHEN tail = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN tail NOT IN ('.', '!', '?') THEN 'truncated'
                        ELSE '' END AS fault, role[1] AS initial, lag(role[1]) OVER (PARTITION BY c ORDER BY i) AS before FROM seq),
facts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
         count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
         count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM rows GROUP BY c),
ins(q, q2, cost, e, t) AS (VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
  (0, 2, 3, 'I', ['user:']), (1, 2, 3, 'I', ['user:']), (3, 2, 3, 'I', ['user:']), (2, 3, 3, 'I', ['assistant:']),
  (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 3, 6, 'II', ['user:', 'assistant:'])),
edit(q, e, initial, cost, q2, role) AS (VALUES
  (0, 'K', 's', 0, 1, NULL), (0, 'K', 'u', 0, 2, NULL), (1, 'K', 'u', 0, 2, NULL), (3, 'K', 'u', 0, 2, NULL), (2, 'K', 'a', 0, 3, NULL),
  (0, 'R', NULL, 3, 2, 'user'), (1, 'R', NULL, 3, 2, 'user'), (3, 'R', NULL, 3, 2, 'user'), (2, 'R', NULL, 3, 3, 'assistant'),
  (0, 'D', NULL, 4, 0, NULL), (1, 'D', NULL, 4, 1, NULL), (2, 'D', NULL, 4, 2, NULL), (3, 'D', NULL, 4, 3, NULL)),
best(c, i, q, v) AS (
  SELECT c, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': '', 't': []::VARCHAR[]}} FROM facts UNION ALL
  SELECT b.c, b.i + 1, e.q2, min({{'cost': b.v.cost + x.cost + e.cost + CASE WHEN e.e <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END,
                                  'audit': b.v.audit || x.e || e.e,
                                  't': b.v.t || x.t || CASE WHEN e.e = 'D' THEN [] ELSE [coalesce(e.role, r.role) || ':' || text] END}})
  FROM best b JOIN rows r ON r.c = b.c AND r.i = b.i + 1 JOIN ins x ON x.q = b.q JOIN edit e ON e.q = x.q2
  WHERE (e.e = 'D' OR fault NOT IN ('blank', 'duplicate')) AND (e.initial IS NULL OR e.initial = r.initial)
  GROUP BY b.c, b.i + 1, e.q2),
goal AS (
  SELECT c, min({{'cost': v.cost + x.cost, 'audit': v.audit || x.e, 't': v.t || x.t}}) AS v
  FROM best b JOIN facts f USING (c) JOIN ins x ON x.q = b.q AND x.q2 IN (0, 3) WHERE b.i = f.n GROUP BY c)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v.cost, 0)::BIGINT AS cost,
       coalesce(v.audit, '') AS audit, sha256(coalesce(array_to_string(v.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM src) LEFT JOIN facts USING (c) LEFT JOIN goal USING (c)"""

SQL = {"op3_topk": OP3, "op6_substring_dedup": OP6, "op8_ngram_join": OP8, "op11_merkle": OP11, "op13_conversation": OP13}
