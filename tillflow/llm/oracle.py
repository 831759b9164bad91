"""DuckDB SQL for the operators that SQL can express."""

_WORDS = ("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

#: A digest as a number from 0 up to 1.
_UNIT = "('0x' || substr(md5({}), 1, 8))::BIGINT / 4294967296.0::DOUBLE"

ORACLES = {}

ORACLES["op3_mix_sources"] = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
d2 AS (
  SELECT *, CASE WHEN size > 0 THEN floor(log2(size::DOUBLE) * 6) + 1 ELSE 0 END AS class,
    floor({_UNIT.format("'mix#' || coalesce(doc_id::VARCHAR, '')")}
          * (SELECT count(*) // 20000 + 1 FROM documents)) AS chunk
  FROM d),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, chunk, size, doc_id::VARCHAR) AS rank
  FROM d2),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS w
  FROM d GROUP BY source),
p AS (
  SELECT *, (source_size * 2)::DOUBLE / w AS ratio,
    (sum(source_size) OVER () * 1.5::DOUBLE
     - coalesce(sum((source_size * 2)::DOUBLE) OVER (ORDER BY (source_size * 2)::DOUBLE / w, source NULLS LAST
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY (source_size * 2)::DOUBLE / w, source NULLS LAST
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS price
  FROM s),
t AS (
  SELECT source, source_size,
    least((source_size * 2)::DOUBLE,
          coalesce((SELECT arg_min(price, ratio) FROM p WHERE price <= ratio) * w, (source_size * 2)::DOUBLE)) AS target
  FROM p),
e AS (
  SELECT r.*, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS each,
    {_UNIT.format("'mix#offset#' || coalesce(r.source, '')")} AS u
  FROM ranked r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  ((floor(rank * each + u) - floor((rank - 1) * each + u)) * size)::BIGINT AS taken
FROM e"""

ORACLES["op4_decontaminate"] = f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS ws FROM documents),
i AS (SELECT item_id::VARCHAR AS item_id, {_WORDS} AS ws FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, len(ws[k:k + 9]) AS n, array_to_string(ws[k:k + 9], ' ') AS phrase
  FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 9))) AS k FROM i WHERE len(ws) > 0)),
spots AS (
  SELECT r, n, k, array_to_string(ws[k:k + n - 1], ' ') AS phrase
  FROM (SELECT r, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS k
        FROM w, (SELECT DISTINCT n FROM win) WHERE len(ws) >= n)),
hits AS (SELECT spots.r, spots.k, spots.n, win.item_id FROM spots JOIN win USING (phrase, n)),
per AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(generate_series(k, k + n - 1)) AS p FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN per USING (r) LEFT JOIN items USING (r)"""


ORACLES["op11_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
tok AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS total FROM tok GROUP BY ALL HAVING count(DISTINCT r) >= 10),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM tok SEMI JOIN kept USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS whole FROM kept GROUP BY lang),
g AS (
  SELECT lang, source, coalesce((SELECT sum(n) FROM c WHERE c.lang = s.lang AND c.source = s.source), 0)::HUGEINT AS size
  FROM (SELECT DISTINCT lang, source FROM d) s),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + 1000000000 * (coalesce(c.n, 0) + 2) // (g.size + 2 * l.v) AS p,
    1 + 1000000000 * (k.total + 2) // (l.whole + 2 * l.v) AS q
  FROM g JOIN l USING (lang) JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM dense WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM rows)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10"""

#: Characters that escaping adds: one for each control string of the template.
_ADDED = r"len(regexp_extract_all({}, '[<\[]\\*(?:/?s>|/?INST\]|</?SYS>>|br>)'))"

ORACLES["op2_chat_format"] = rf"""
WITH log AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns AS (SELECT conv_id::BIGINT AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM log)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<s>') + length(role) + {_ADDED.format("role")} + 3 * (length(role) - length(replace(role, chr(10), '')))
      + 1 + length(text) + {_ADDED.format("text")} + length('</s>') + 1)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id"""

# Vectors are divided by their largest component, so that no square overflows or vanishes.
ORACLES["op7_near_vectors"] = """
WITH RECURSIVE given AS (SELECT row_number() OVER () AS r, vec_id::BIGINT AS vec_id, embedding::DOUBLE[] AS v FROM embeddings),
scaled AS (
  SELECT r, vec_id, [x / list_max([abs(y) for y in v]) for x in v] AS v
  FROM given WHERE len(v) > 0 AND list_count(v) = len(v) AND list_bool_and([isfinite(x) for x in v])
    AND list_max([abs(x) for x in v]) > 0),
units AS (SELECT r, vec_id, [x / sqrt(list_dot_product(v, v)) for x in v] AS v FROM scaled),
links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b, b.vec_id AS other FROM units a JOIN units b ON a.r <> b.r AND len(a.v) = len(b.v)
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_dot_product(a.v, b.v) END >= 0.9),
reach AS (
  SELECT DISTINCT a AS r, a AS other FROM links
  UNION SELECT reach.r, links.b FROM reach JOIN links ON reach.other = links.a),
lowest AS (SELECT reach.r, min(given.vec_id) AS component_id FROM reach JOIN given ON reach.other = given.r GROUP BY reach.r),
counts AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links,
  CASE WHEN n IS NULL THEN vec_id ELSE component_id END AS component_id,
  vec_id IS NOT DISTINCT FROM CASE WHEN n IS NULL THEN vec_id ELSE component_id END AS kept
FROM given LEFT JOIN counts USING (r) LEFT JOIN lowest USING (r)"""
