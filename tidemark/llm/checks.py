"""SQL for the queries of this folder that SQL can express; the rest have brute-force tests."""

from __future__ import annotations

from tidemark.llm import line_rules, mixing

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BOILERPLATE = "|".join(line_rules.BOILERPLATE)

LINE_RULES = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
listed AS (SELECT rid, {_WORDS} AS ws FROM d),
words AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM listed),
threes AS (
  SELECT rid, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS three
  FROM words WINDOW o AS (PARTITION BY rid ORDER BY i)),
again AS (SELECT rid, i FROM threes WHERE three IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, three) > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY rid),
split AS (SELECT rid, string_split(text, chr(10)) AS ls FROM d),
lines AS (SELECT rid, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM split),
marked AS (
  SELECT rid, line, i, len(regexp_extract_all(line, '\\S+')) AS words,
    len(regexp_extract_all(line, '{line_rules.MENU_MARKS}')) AS menu,
    len(regexp_extract_all(line, '{line_rules.NOISE_MARKS}')) AS noise
  FROM lines),
judged AS (
  SELECT *, CASE WHEN words = 0 THEN NULL
    WHEN menu >= 2 AND menu * 4 >= words THEN 'navigation'
    WHEN noise * 3 > words THEN 'punctuation'
    WHEN words >= 3 AND line = upper(line) AND line <> lower(line) THEN 'punctuation'
    WHEN words >= 5 AND NOT regexp_matches(line, '{line_rules.ENDS}') THEN 'punctuation'
    WHEN regexp_matches(lower(line), '{_BOILERPLATE}') THEN 'boilerplate' END AS fault
  FROM marked),
clean AS (
  SELECT rid, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (fault IS NULL), '') AS text,
    count(*) FILTER (fault = 'punctuation') AS n_punctuation, count(*) FILTER (fault = 'navigation') AS n_navigation,
    count(*) FILTER (fault = 'boilerplate') AS n_boilerplate,
    count(*) FILTER (trim(line, {_BLANKS}) <> '') - count(DISTINCT line) FILTER (trim(line, {_BLANKS}) <> '') AS n_dup_lines
  FROM judged GROUP BY rid),
counts AS (
  SELECT d.rid, d.doc_id, len(l.ws)::BIGINT AS n_words,
    length(regexp_replace(d.text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(d.text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    c.n_dup_lines::BIGINT AS n_dup_lines, coalesce(v.n, 0)::BIGINT AS n_repeat_words,
    length(trim(d.text, {_BLANKS})) AS whole, length(trim(c.text, {_BLANKS})) AS remaining,
    c.n_punctuation, c.n_navigation, c.n_boilerplate
  FROM d JOIN listed l USING (rid) JOIN clean c USING (rid) LEFT JOIN covered v USING (rid)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (whole = 0 OR (whole - remaining) * 100 / whole <= {line_rules.MAX_LOSS_PERCENT}) AS kept,
  n_punctuation, n_navigation, n_boilerplate
FROM based
"""

MIX = f"""
WITH sizes AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
    md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS draw
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT source, source_size, 2 * source_size AS cap,
    [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INTEGER] AS w
  FROM per),
level AS (
  SELECT *, ((SELECT sum(source_size) * 3 / 2 FROM per) - (sum(cap) OVER o - cap))
    / ((SELECT sum(w) FROM weighed) - (sum(w) OVER o - w)) AS l
  FROM weighed WINDOW o AS (ORDER BY cap / w, source IS NULL, source ROWS UNBOUNDED PRECEDING)),
final AS (SELECT max(l) AS f FROM level WHERE cap > l * w),
targets AS (SELECT source, source_size, least(cap::DOUBLE, coalesce(f * w, cap::DOUBLE)) AS target FROM level, final),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets),
missing AS (SELECT *, target - whole * source_size AS need FROM plan),
run AS (
  SELECT s.*, m.source_size, m.target, m.whole, m.need,
    sum(size) OVER o AS upto, row_number() OVER o AS place
  FROM sizes s JOIN missing m ON s.source IS NOT DISTINCT FROM m.source
  WINDOW o AS (PARTITION BY s.source ORDER BY draw, size ROWS UNBOUNDED PRECEDING)),
last AS (
  SELECT source, coalesce(max(upto) FILTER (upto <= need), 0) AS filled
  FROM run WHERE need > 0 GROUP BY source),
filler AS (
  SELECT r.source, arg_min(place, (abs(size - (need - filled)), draw, place)) AS fill_place
  FROM run r JOIN last l ON r.source IS NOT DISTINCT FROM l.source
  WHERE need > 0 AND upto > need AND abs(size - (need - filled)) < need - filled GROUP BY r.source),
taken AS (
  SELECT r.*, whole + CASE WHEN (need > 0 AND upto <= need) OR place = fill_place THEN 1 ELSE 0 END AS n
  FROM run r LEFT JOIN filler f ON r.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, size, source_size, target, (size * n)::BIGINT AS taken, n::BIGINT AS copies FROM taken
"""

NEAREST = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
usual AS (SELECT len(e) AS n FROM v GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1),
fine AS (SELECT v.* FROM v, usual WHERE len(e) = n),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]), lambda x, y: x + y) AS score
  FROM fine q JOIN fine c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

REPEATS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
windows AS (
  SELECT rid, unnest(range(1, len(ws) - 33)) AS i,
    unnest(list_transform(range(1, len(ws) - 33), lambda i: md5(array_to_string(ws[i:i + 34], ' ')))) AS h
  FROM d WHERE len(ws) >= 35),
again AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY h) > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS i FROM again),
words AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM words w WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.rid = w.rid AND g.i = w.i) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(k.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (rid)
"""

NEAR = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s
  FROM d),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS id, doc_id AS other FROM documents
  UNION SELECT r.id, e.b FROM reach r JOIN edges e ON r.other = e.a),
named AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) JOIN named ON id = d.doc_id
"""

# crc32 by half bytes: the table of its 16 steps, from the rule
_HALVES = [0] * 16
for _i in range(16):
    _h = _i
    for _ in range(4):
        _h = (_h >> 1) ^ (0xEDB88320 if _h & 1 else 0)
    _HALVES[_i] = _h

VARIANTS = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, lower_run AS run, count(*) AS c, coalesce(doc_id::VARCHAR, '') || ':' || lower_run AS named
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[a-z\u00C0-\u00FF]+')) AS lower_run
    FROM documents WHERE text IS NOT NULL)
  GROUP BY ALL),
halves AS (
  SELECT run, c, list_transform(range(0, length(hex(named))::BIGINT), lambda i:
    instr('123456789ABCDEF', substr(hex(named), (CASE WHEN i % 2 = 0 THEN i + 2 ELSE i END)::INT, 1))::BIGINT) AS hs
  FROM runs),
hashed AS (
  SELECT run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, hs), lambda h, x:
    xor(h >> 4, {_HALVES}[(xor(h, x) & 15) + 1])), 4294967295::BIGINT) AS h
  FROM halves),
damaged AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, c FROM hashed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
cut AS (SELECT word, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word),
best AS (
  SELECT a AS word, count(*) AS n_near, min({{'less': -w.n, 'form': b}}) AS best FROM pairs JOIN words w ON w.word = b GROUP BY a),
formed AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 2 * n THEN best.form END AS form,
    CASE WHEN -best.less >= 2 * n THEN -best.less END AS form_n
  FROM words w LEFT JOIN best USING (word)),
climb AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT c.word, f.form FROM climb c JOIN formed f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n
FROM formed f JOIN climb c USING (word) JOIN formed last ON last.word = c.at AND last.form IS NULL
"""

CHECKS: dict[str, str] = {
    "op3_line_rules": LINE_RULES,
    "op5_water_filling_mix": MIX,
    "op8_vantage_point_search": NEAREST,
    "op9_seed_extend": REPEATS,
    "op10_coordinate_join": NEAR,
    "op12_pivotal_grams": VARIANTS,
}
