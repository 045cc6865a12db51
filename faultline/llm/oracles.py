"""DuckDB SQL for the operators that SQL can express on whole tables."""

from __future__ import annotations

_COMPONENTS = """
reach AS (
  SELECT a AS node, least(a, b) AS r FROM links
  UNION SELECT a, r FROM (SELECT l.a, reach.r FROM links l JOIN reach ON reach.node = l.b))
"""

OP1 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT o.a, o.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id) o
  JOIN sizes p ON p.doc_id = o.a JOIN sizes q ON q.doc_id = o.b WHERE 100 * o.o >= 75 * (p.n + q.n - o.o)),
""" + _COMPONENTS + """
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.r, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes z USING (doc_id)
LEFT JOIN (SELECT node, min(r) AS r FROM reach GROUP BY node) c ON c.node = d.doc_id
"""

OP4 = r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
bw AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, unnest(list_transform(range(1, greatest(1, len(w) - 12) + 1),
    lambda i: array_to_string(w[i:i + 12], ' '))) AS s FROM bw WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
starts AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lengths WHERE len(w) >= n),
hits AS (
  SELECT t.doc_id, t.i, t.n, x.item_id FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM starts) t
  JOIN windows x ON x.n = t.n AND x.s = t.s),
per_word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
per_item AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS items FROM (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
  sha256(coalesce(i.items, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM dw d LEFT JOIN per_word h USING (doc_id) LEFT JOIN per_item i USING (doc_id)
"""

OP9 = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(length('<turn>') + length(replace(replace(replace(role, '\', '\\'), '<', '\<'), chr(10), '\n')) + 1
    + length(replace(replace(text, '\', '\\'), '<', '\<')) + length('</turn>') + 1) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""

OP10 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n
  FROM embeddings),
links AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND x.n > 0 AND y.n > 0
  WHERE list_dot_product(x.e, y.e) / (x.n * y.n) >= 0.9),
""" + _COMPONENTS + """
SELECT v.vec_id, coalesce(k.n, 0) AS n_links, least(v.vec_id, coalesce(c.r, v.vec_id)) AS component_id,
  least(v.vec_id, coalesce(c.r, v.vec_id)) = v.vec_id AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) k ON k.a = v.vec_id
LEFT JOIN (SELECT node, min(r) AS r FROM reach GROUP BY node) c ON c.node = v.vec_id
"""

OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
    sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
    CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
         WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
s AS (SELECT *, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m, array_to_string(w[b + 1:n], '') AS s FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM s
"""

OP12 = r"""
WITH l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
f AS MATERIALIZED (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask FROM d LEFT JOIN l USING (doc_id)),
x AS (SELECT unnest(range(5)) AS i),
o AS MATERIALIZED (SELECT a.i AS a, b.i AS b, c.i AS c, e.i AS d, g.i AS e FROM x a JOIN x b ON b.i <> a.i
  JOIN x c ON c.i NOT IN (a.i, b.i) JOIN x e ON e.i NOT IN (a.i, b.i, c.i) JOIN x g ON g.i NOT IN (a.i, b.i, c.i, e.i)),
steps AS (SELECT list_aggregate(list_transform([a, b, c, d, e], lambda i: chr(CAST(65 + i AS INTEGER))), 'string_agg', '') AS filter_order,
  step, [a, b, c, d, e][step] AS f, [0, 1 << a, (1 << a) + (1 << b), (1 << a) + (1 << b) + (1 << c), 31 - (1 << e)][step] AS s
  FROM o, (SELECT unnest(range(1, 6)) AS step)),
cells AS MATERIALIZED (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f GROUP BY part, mask),
told AS MATERIALIZED (SELECT part, filter_order, step, f,
    sum(CASE WHEN (mask & (s + (1 << f))) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN (mask & s) = 0 AND (mask & (1 << f)) <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN (mask & s) <> 0 AND (mask & (1 << f)) <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = (1 << f) THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN (mask & s) = 0 AND (mask & (1 << f)) <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN (mask & s) = 0 AND (mask & (1 << f)) <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM told
"""

OP13 = r"""
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
    lambda x: x <> '')) AS size, substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS draw FROM documents),
s AS (SELECT source, sum(size) AS size, 3 * sum(size) AS cap,
    [5, 2, 1][CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight FROM d GROUP BY source),
-- Sources by the level at which each is full: those up to a place are clamped, the level of the rest follows.
p AS (SELECT *, sum(size) OVER () AS total, sum(cap) OVER full_first AS caps,
    sum(weight) OVER () - sum(weight) OVER full_first AS weight_left,
    FROM s WINDOW full_first AS (ORDER BY cap / weight, encode(source) NULLS LAST ROWS UNBOUNDED PRECEDING)),
q AS (SELECT *, coalesce(lag(caps) OVER o, 0) AS caps_before, weight_left + weight AS weight_here FROM p
  WINDOW o AS (ORDER BY cap / weight, encode(source) NULLS LAST)),
-- The first source that is not full at the level dealt to it and to all later ones.
lev AS (SELECT arg_min(CAST(total - caps_before AS HUGEINT), caps) AS words, arg_min(weight_here, caps) AS weight FROM q
  WHERE CAST(cap AS HUGEINT) * weight_here > CAST(total - caps_before AS HUGEINT) * weight),
t AS (SELECT s.source, s.size, CASE WHEN lev.words IS NULL OR CAST(cap AS HUGEINT) * lev.weight <= lev.words * s.weight
      THEN CAST(cap AS DOUBLE) ELSE CAST(lev.words * s.weight AS DOUBLE) / lev.weight END AS target,
    CASE WHEN lev.words IS NULL OR CAST(cap AS HUGEINT) * lev.weight <= lev.words * s.weight
      THEN cap ELSE lev.words * s.weight // lev.weight END AS words FROM s, lev),
r AS (SELECT d.doc_id, d.size, t.size AS source_size, t.target, t.words // greatest(t.size, 1) AS copies,
    t.words - t.words // greatest(t.size, 1) * t.size AS rest,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY draw, d.doc_id NULLS FIRST, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(size * (copies + CASE WHEN rest > 0 AND 2 * before + size <= 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""

ORACLES = {"op1_ngram_jaccard_join": OP1, "op4_decontamination": OP4, "op9_chat_format": OP9, "op10_embedding_dedup": OP10,
           "op11_fill_in_middle": OP11, "op12_filter_audit": OP12, "op13_source_mix": OP13}
