"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op4_line_dedup"] = r"""
WITH line AS (
  SELECT doc_id, coalesce(text, '') AS body, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
unit AS (
  SELECT doc_id, unnest(range(len(ls))) AS pos,
         unnest(list_transform(ls, lambda x: trim(translate(x, chr(9) || chr(13), '  ')))) AS l FROM line),
win AS (
  SELECT doc_id, pos, l AS a, lead(l) OVER w AS b, lead(l, 2) OVER w AS c FROM unit
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS nth
  FROM win WHERE c IS NOT NULL AND a || b || c <> ''),
gone AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM ranked, (VALUES (0), (1), (2)) t(k) WHERE nth > 1),
whole AS (
  SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS l FROM line)
SELECT w.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
       coalesce(string_agg(w.l, chr(10) ORDER BY w.pos) FILTER (WHERE g.pos IS NULL), '') AS text
FROM whole w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.pos = w.pos
GROUP BY w.doc_id
"""

ORACLE["op8_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS key
  FROM documents),
src AS (
  SELECT source, sum(size) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source),
fill AS (
  SELECT *, 2 * source_size AS cap, CAST(2 * source_size AS DOUBLE) / weight AS ratio,
         CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS total FROM src),
level AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
         sum(weight) OVER (ORDER BY ratio, source NULLS LAST
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM fill),
capped AS (SELECT *, ratio * open_weight <= total - below AS full_up FROM level),
target AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
         CASE WHEN full_up THEN CAST(cap AS DOUBLE)
              ELSE (total - coalesce(sum(CASE WHEN full_up THEN cap END) OVER (), 0))
                   / (sum(CASE WHEN NOT full_up THEN weight END) OVER ()) * weight END AS target
  FROM capped),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY substr(s.key, 1, 13), s.doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source),
cut AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM cut
"""

ORACLE["op5_hamming_top_k"] = r"""
WITH bits AS (
  SELECT vec_id, unnest(range(64)) AS i, unnest(embedding[1:64]) AS x FROM embeddings),
code AS (
  SELECT vec_id, list(CASE WHEN x > 0 THEN 1 ELSE 0 END ORDER BY i) AS c FROM bits GROUP BY vec_id),
pair AS (
  SELECT q.vec_id AS query_id, d.vec_id AS neighbor_id,
         CAST(len(list_filter(list_zip(q.c, d.c), lambda z: z[1] <> z[2])) AS INTEGER) AS distance
  FROM code q JOIN code d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank FROM pair)
SELECT query_id, neighbor_id, distance, rank FROM ranked WHERE rank <= 10
"""

ORACLE["op2_preference_pairs"] = r"""
WITH turns AS (SELECT conv_id AS pair_id, turn, role, coalesce(text, '') AS text FROM conversations),
last AS (
  SELECT pair_id, max(turn) AS turn, arg_max(text, turn) AS text FROM turns WHERE role = 'assistant' GROUP BY pair_id),
a AS (
  SELECT t.* FROM turns t LEFT JOIN last l USING (pair_id) WHERE l.turn IS NULL OR t.turn <= l.turn),
b AS (
  SELECT t.* FROM turns t LEFT JOIN last l USING (pair_id) WHERE l.turn IS NULL OR t.turn < l.turn
  UNION ALL
  SELECT l.pair_id, l.turn, 'assistant', o.text FROM last l JOIN last o ON o.pair_id = xor(l.pair_id, 1)),
na AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY turn) AS n FROM a),
nb AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY turn) AS n FROM b),
met AS (
  SELECT coalesce(na.pair_id, nb.pair_id) AS pair_id, coalesce(na.n, nb.n) AS n,
         na.role AS ra, na.text AS ta, nb.role AS rb, nb.text AS tb,
         na.n IS NOT NULL AND nb.n IS NOT NULL AND na.role = nb.role AND na.text = nb.text AS same
  FROM na FULL JOIN nb ON na.pair_id = nb.pair_id AND na.n = nb.n),
cut AS (
  SELECT *, CAST(coalesce(min(CASE WHEN NOT same THEN n END) OVER (PARTITION BY pair_id) - 1,
                          count(*) OVER (PARTITION BY pair_id)) AS INTEGER) AS shared_turns FROM met),
shown AS (
  SELECT *, '<|' || replace(ra, '<|', '< |') || '|>' || chr(10) || replace(ta, '<|', '< |') || '<|end|>' || chr(10) AS wa,
         '<|' || replace(rb, '<|', '< |') || '|>' || chr(10) || replace(tb, '<|', '< |') || '<|end|>' || chr(10) AS wb
  FROM cut)
SELECT pair_id, shared_turns,
       coalesce(string_agg(wa, '' ORDER BY n) FILTER (WHERE n <= shared_turns), '') AS prompt,
       coalesce(string_agg(wa, '' ORDER BY n) FILTER (WHERE n > shared_turns), '') AS chosen,
       coalesce(string_agg(wb, '' ORDER BY n) FILTER (WHERE n > shared_turns), '') AS rejected,
       coalesce(string_agg(length(wa) || CASE WHEN ra = 'assistant' THEN '+' ELSE '-' END, ',' ORDER BY n)
                FILTER (WHERE n > shared_turns AND wa IS NOT NULL), '') AS chosen_mask,
       coalesce(string_agg(length(wb) || CASE WHEN rb = 'assistant' THEN '+' ELSE '-' END, ',' ORDER BY n)
                FILTER (WHERE n > shared_turns AND wb IS NOT NULL), '') AS rejected_mask
FROM shown GROUP BY pair_id, shared_turns
"""

ORACLE["op3_benchmark_overlap"] = r"""
WITH word AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') FROM benchmark),
pos AS (SELECT side, id, len(w) AS n, unnest(range(len(w))) AS p, unnest(w) AS t FROM word),
hit AS (
  SELECT d.id AS doc_id, b.id AS item_id, d.p - b.p AS diag
  FROM pos d JOIN pos b ON d.t = b.t AND d.side = 'd' AND b.side = 'b'
  GROUP BY ALL HAVING count(*) >= ceil(least(max(b.n), 13) * 0.8)),
lined AS (
  SELECT h.doc_id, h.item_id, greatest(h.diag, 0) AS doc_start, greatest(-h.diag, 0) AS item_start,
         least(len(d.w) - greatest(h.diag, 0), len(b.w) - greatest(-h.diag, 0)) AS overlap,
         least(len(b.w), 13) AS need, d.w AS dw, b.w AS bw
  FROM hit h JOIN word d ON d.side = 'd' AND d.id = h.doc_id JOIN word b ON b.side = 'b' AND b.id = h.item_id),
cell AS (
  SELECT doc_id, item_id, doc_start, item_start, overlap, need, unnest(range(overlap)) AS i,
         unnest(list_transform(list_zip(dw[doc_start + 1 : doc_start + overlap], bw[item_start + 1 : item_start + overlap]),
                               lambda z: CASE WHEN z[1] = z[2] THEN 1 ELSE 0 END)) AS same
  FROM lined WHERE overlap >= need),
run AS (
  SELECT *, sum(same) OVER (PARTITION BY doc_id, item_id, doc_start, item_start ORDER BY i
                            ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS s13,
         sum(same) OVER (PARTITION BY doc_id, item_id, doc_start, item_start) AS matched
  FROM cell),
good AS (
  SELECT DISTINCT doc_id, item_id, doc_start, item_start, overlap, matched FROM run
  WHERE (need = 13 AND i >= 12 AND s13 >= 11)
     OR (need < 13 AND i = overlap - 1 AND s13 >= ceil(need * 0.8)))
SELECT doc_id, item_id, CAST(doc_start AS INTEGER) AS doc_start, CAST(item_start AS INTEGER) AS item_start,
       CAST(overlap AS INTEGER) AS overlap, CAST(matched AS INTEGER) AS matched
FROM good QUALIFY row_number() OVER (PARTITION BY doc_id, item_id
                                     ORDER BY matched DESC, doc_start, item_start DESC) = 1
"""

ORACLE["op13_ranked_search"] = r"""
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS r,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
cell AS (SELECT r, doc_id, term, count(*) AS tf FROM doc GROUP BY ALL),
len AS (SELECT r, sum(tf) AS n FROM cell GROUP BY r),
total AS (SELECT count(*) AS docs, sum(n) AS terms FROM len),
freq AS (SELECT term, count(*) AS df FROM cell GROUP BY term),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                      'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
part AS (
  SELECT a.item_id, c.r, c.doc_id,
         CAST(floor(1000 * ln(CAST(2 * t.docs + 2 AS DOUBLE) / (2 * f.df + 1))) AS BIGINT)
           * ((1000000000 * c.tf) // (1000 * c.tf + 12 * (75 + CAST((25 * l.n * t.docs) // t.terms AS BIGINT)))) AS s
  FROM asked a JOIN cell c USING (term) JOIN len l USING (r) JOIN freq f USING (term), total t),
scored AS (SELECT item_id, r, doc_id, CAST(sum(s) AS BIGINT) AS score FROM part GROUP BY ALL HAVING sum(s) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
       doc_id, score
FROM scored QUALIFY rank <= 20
"""
