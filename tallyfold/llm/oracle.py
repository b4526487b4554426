"""DuckDB SQL for the queries that SQL can express."""

from . import line_quality as Q

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ANCHORS = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS s,
    unnest(list_transform(range(1, len(w) - 18), lambda i: array_to_string(w[i:i + 19], ' '))) AS k
  FROM d WHERE len(w) >= 20),
late AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM win)
  WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM late),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS words FROM word
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = word.doc_id AND gone.p = word.p) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

def _pattern(java: str) -> str:
    """A pattern of the library as an SQL text; case folds by Unicode here without being asked to."""
    return "'" + java.replace("(?iu)", "(?i)").replace("'", "''") + "'"


def _phrase(phrase: str) -> str:
    return "'" + phrase.replace("'", "''") + "'"


SYMBOLS = "len(regexp_extract_all(%s, '[#*$%%&|<>]'))"
STOCK = " OR ".join(f"contains(lower(text), {_phrase(p)})" for p in Q.BOILERPLATE)
HELD = " + ".join(f"contains(lower(l), {_phrase(p)})::INT" for p in Q.BOILERPLATE)
SIGNS = " OR ".join(f"regexp_matches(l, {_pattern(sign)})" for sign in Q.FURNITURE_SIGNS)
# The rules for one line; the phrases are the library's fixed values.
LINE_FAILS = rf"""
  (NOT regexp_matches(l, '[^ \x09-\x0D][ \x09-\x0D]+[^ \x09-\x0D]+[ \x09-\x0D]+[^ \x09-\x0D]')
    AND NOT regexp_matches(l, '[.!?:;…。！？]["''”’»)\]]*[ \x09-\x0D]*$')
    AND NOT regexp_matches(l, '[\x{{0E00}}-\x{{0EFF}}\x{{1000}}-\x{{109F}}\x{{1780}}-\x{{17FF}}\x{{3040}}-\x{{30FF}}\x{{3400}}-\x{{9FFF}}]{{10}}'))
  OR symbols * 100 > size * 10 OR letters * 100 < filled * 50 OR (separators >= 3 AND size < separators * 25)
  OR (size < 1000 AND regexp_matches(l, {_pattern(Q.NAVIGATION)}))
  OR (stock AND size < 300 AND held > 0 AND (held > 1 OR rest * 4 <= size OR signs
    OR (rest * 2 <= size AND NOT regexp_matches(l, '[.!?;…。！？]["''”’»)\]]*[ \x09-\x0D]*$'))))"""
MEASURED = rf"""regexp_matches(l, '[^\x20\x09-\x0D]') AS has_word, length(l) AS size, {SYMBOLS % "l"} AS symbols,
    len(regexp_extract_all(l, '[|•]')) + CASE WHEN regexp_matches(l, '[«‹]') THEN 0
      ELSE len(regexp_extract_all(l, '[»›]')) END AS separators,
    length(regexp_replace(l, '[^\p{{L}}]+', '', 'g')) AS letters, length(regexp_replace(l, '[ \x09-\x0D]+', '', 'g')) AS filled,
    {HELD} AS held, {SIGNS} AS signs, length(regexp_replace(lower(l), {_pattern("|".join(Q.BOILERPLATE))}, '', 'g')) AS rest"""

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
tri AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS p,
    unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS k
  FROM d WHERE len(w) >= 3),
again AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM tri) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 3)) AS q FROM again) GROUP BY doc_id),
line AS (SELECT doc_id, {STOCK} AS stock, unnest(string_split(text, chr(10))) AS l FROM d),
measured AS (SELECT doc_id, l, stock, {MEASURED} FROM line),
judged AS (SELECT doc_id, l, has_word, has_word AND ({LINE_FAILS}) AS fails FROM measured),
lines AS (
  SELECT doc_id, count(*) FILTER (has_word) - count(DISTINCT l) FILTER (has_word) AS dup,
    count(*) FILTER (fails) AS gone,
    sum(CASE WHEN fails THEN length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) ELSE 0 END) AS lost
  FROM judged GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    ({SYMBOLS % "text"})::BIGINT AS n_symbols, dup::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    gone::BIGINT AS n_lines_removed, lost
  FROM d JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines_removed,
  n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
  NOT (n_words < 50 OR n_repeat_words * 100 > n_words * 50) AND lost * 100 <= word_chars * 50 AS kept
FROM base
"""

CELLS = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
counted AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT reach.x AS vec_id, coalesce(any_value(n), 0)::BIGINT AS n_links, min(y) AS component_id, min(y) = reach.x AS kept
FROM reach LEFT JOIN counted ON counted.x = reach.x GROUP BY reach.x
"""

MIXING = """
WITH RECURSIVE p AS (
  SELECT doc_id, coalesce(source, 'none') AS key, greatest(length(coalesce(text, '')), 1)::BIGINT AS size,
    md5(doc_id::VARCHAR || ':0') AS place FROM documents),
q AS (
  SELECT *, ('0x' || substr(place, 1, 8))::BIGINT % (SELECT ceil(sqrt(count(*)))::BIGINT FROM documents) AS piece FROM p),
w AS (SELECT key, greatest(floor(sqrt(sum(size)))::BIGINT, 1) AS weight FROM q GROUP BY key),
n AS (
  SELECT key, weight, (sum(weight) OVER ())::BIGINT AS total, count(*) OVER () AS n,
    greatest(1000, 2 * count(*) OVER ()) AS period FROM w),
s AS (
  SELECT key, period, period - n AS free, ((period - n) * weight) // total AS whole,
    ((period - n) * weight) % total AS rest FROM n),
parts AS (
  SELECT key, period, (1 + whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, key) <= free - sum(whole) OVER ()
    THEN 1 ELSE 0 END)::BIGINT AS parts FROM s),
arr AS (SELECT list(parts ORDER BY key) AS ps, list(key ORDER BY key) AS ks, any_value(period) AS period FROM parts),
edf(t, served, k) AS (
  SELECT -1::BIGINT, list_transform(ps, lambda x: 0::BIGINT), NULL::BIGINT FROM arr
  UNION ALL
  SELECT t + 1, list_transform(served, lambda c, i: CASE WHEN i = pick THEN c + 1 ELSE c END), pick
  FROM (
    SELECT t, served, (list_min(list_transform(range(1, len(ps) + 1), lambda i: CASE WHEN served[i] * period // ps[i] <= t + 1
      THEN (((served[i] + 1) * period + ps[i] - 1) // ps[i]) * 1000000 + i END)) % 1000000)::BIGINT AS pick
    FROM edf, arr WHERE t + 1 < period)),
turns AS (
  SELECT ks[k] AS key, t, row_number() OVER (PARTITION BY k ORDER BY t) - 1 AS j FROM edf, arr WHERE k IS NOT NULL),
blocks AS (
  SELECT doc_id, key, place, (coalesce(sum(size) OVER (PARTITION BY key ORDER BY piece, place, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 65536)::BIGINT AS block FROM q)
SELECT doc_id, key AS mix_source, block, (block // parts * period + t)::BIGINT AS slot, place
FROM blocks JOIN parts USING (key) JOIN turns ON turns.key = blocks.key AND turns.j = block % parts
"""

CRC_TABLE = """-- CRC-32 by bytes: DuckDB has no such function.
table_step(i, k, v) AS (
  SELECT i::UBIGINT, 0, i::UBIGINT FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END
  FROM table_step WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM table_step WHERE k = 8),
"""
CRC = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
    string_split(%s, ''), lambda c: ascii(c)::UBIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a & 255, b)::BIGINT) + 1])), 4294967295::UBIGINT)"""

STRUCTURE = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
{CRC_TABLE}kinds AS (
  SELECT conv_id, turn, role, text, ({CRC % "name"} % 20)::INT AS kind
  FROM keyed, crc_table),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS r FROM hurt),
faulty AS (
  SELECT conv_id, turn, i, role, text, left(role, 1) AS c,
    CASE WHEN r = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(r, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM ranked),
step(p, c, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
fill(p, q, line) AS (VALUES (0, 2, 'user:'), (1, 2, 'user:'), (2, 3, 'assistant:'), (3, 2, 'user:')),
ins(p, q, cost, edits, lines) AS (
  SELECT p, p, 0, '', '' FROM (VALUES (0), (1), (2), (3)) v(p)
  UNION ALL SELECT p, q, 2, 'I', chr(10) || line FROM fill
  UNION ALL SELECT a.p, b.q, 4, 'II', chr(10) || a.line || chr(10) || b.line FROM fill a JOIN fill b ON a.q = b.p),
way(conv_id, i, q, best) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, {{'cost': 0, 'audit': '', 'lines': ''}} FROM faulty
  UNION ALL
  SELECT conv_id, i, q, min(best) FROM (
    SELECT f.conv_id, f.i, e.q, {{'cost': w.best.cost + n.cost + e.cost, 'audit': w.best.audit || n.edits || e.edit,
      'lines': w.best.lines || n.lines || e.line}} AS best
    FROM way w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1 JOIN ins n ON n.p = w.q,
    LATERAL (
      SELECT n.q AS q, 3 AS cost, 'D' AS edit, '' AS line
      UNION ALL SELECT s.q, (f.fault = 'truncated')::INT, 'K', chr(10) || f.role || ':' || f.text
      FROM step s WHERE s.p = n.q AND s.c = f.c AND f.fault NOT IN ('blank', 'duplicate')
      UNION ALL SELECT l.q, 2 + (f.fault = 'truncated')::INT, 'R', chr(10) || l.line || f.text
      FROM fill l WHERE l.p = n.q AND f.fault NOT IN ('blank', 'duplicate')) e)
  GROUP BY conv_id, i, q),
ended AS (
  SELECT w.conv_id, min({{'cost': w.best.cost + n.cost, 'audit': w.best.audit || n.edits, 'lines': w.best.lines || n.lines}})
    AS best FROM way w JOIN (SELECT conv_id, max(i) AS n FROM faulty GROUP BY conv_id) z
    ON z.conv_id IS NOT DISTINCT FROM w.conv_id AND z.n = w.i
  JOIN ins n ON n.p = w.q AND n.q IN (0, 3) GROUP BY w.conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND before || c NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit,
  sha256(coalesce(best.lines[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

TRIE = rf"""
WITH RECURSIVE {CRC_TABLE}row_of AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
    sha256(coalesce(text, ''))) - 1 AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
conv AS (
  SELECT c, c - c % 5 AS base, {CRC % "c::VARCHAR"} % 9 AS h, n
  FROM (SELECT c, count(*) AS n FROM row_of GROUP BY c), crc_table),
given AS (SELECT conv.c, conv.base, conv.h, least(conv.h, coalesce(b.n, 0)) AS g FROM conv LEFT JOIN conv b ON b.c = conv.base),
turn AS (
  SELECT given.c, pos, role, text FROM given JOIN row_of ON row_of.c = given.base AND pos < g
  UNION ALL SELECT given.c, pos - h + g, role, text FROM given JOIN row_of ON row_of.c = given.c AND pos >= h),
path(c, d, k, bytes) AS (
  SELECT c, 0::BIGINT, '', 0::BIGINT FROM conv
  UNION ALL SELECT p.c, d + 1, sha256(k || length(role) || ':' || role || text), strlen(text)::BIGINT
  FROM path p JOIN turn t ON t.c = p.c AND t.pos = p.d),
size AS (SELECT c, max(d) AS n FROM path GROUP BY c),
node AS (
  SELECT d, k, min(path.c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(path.c::VARCHAR, ',' ORDER BY path.c) FILTER (n = d), '')) AS ends_sha256
  FROM path JOIN size USING (c) GROUP BY d, k),
linked AS (
  SELECT node.*, up.k AS pk FROM node LEFT JOIN path up ON up.c = node.conv_id AND up.d = node.d - 1),
children AS (SELECT d - 1 AS d, pk AS k, count(*) AS n FROM linked WHERE d > 0 GROUP BY ALL),
under AS (
  SELECT up.d, up.k, count(*) FILTER (children.n IS NULL) AS n_leaves, sum((node.n_convs - 1) * node.bytes) AS saved
  FROM node JOIN path up ON up.c = node.conv_id AND up.d <= node.d
  LEFT JOIN children ON children.d = node.d AND children.k = node.k GROUP BY up.d, up.k)
SELECT l.conv_id, l.d AS depth, p.conv_id AS parent_conv_id, l.n_convs, coalesce(children.n, 0)::BIGINT AS n_children,
  n_leaves, saved::BIGINT AS saved_tokens, l.ends_sha256
FROM linked l JOIN under USING (d, k) LEFT JOIN node p ON p.d = l.d - 1 AND p.k = l.pk
LEFT JOIN children ON children.d = l.d AND children.k = l.k
"""

ORACLE: dict[str, str] = {
    "op2_anchor_dedup": ANCHORS,
    "op6_line_quality": QUALITY,
    "op7_spherical_cells": CELLS,
    "op8_pfair_mixing": MIXING,
    "op12_prefix_trie": TRIE,
    "op13_structure_repair": STRUCTURE,
}
