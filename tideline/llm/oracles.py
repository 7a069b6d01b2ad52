"""The SQL (DuckDB) that the queries of this subpackage are checked against."""

from __future__ import annotations

from . import license_scan, mixing, url_filter

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: eight hex digits of a digest as a number
DIGEST = "('0x' || substr(md5({0}), 1, 8))::bigint"

HOST_QUALITY_RULES = rf"""
WITH base AS (
  SELECT doc_id, source, coalesce(text, '') AS t, {WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
places AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base WHERE len(w) > 2)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM places) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY doc_id),
measures AS (
  SELECT doc_id, source, len(w)::bigint AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint AS n_dup_lines,
         coalesce(n, 0)::bigint AS n_repeat_words
  FROM base LEFT JOIN covered USING (doc_id)),
hosts AS (
  SELECT source, count(*) AS n, count_if(n_words < 50) AS k1, count_if(100 * n_repeat_words > 50 * n_words) AS k2,
         count_if(10 * n_symbols > n_words) AS k3, count_if(5 * n_dup_lines > n_words) AS k4
  FROM measures GROUP BY source),
long AS (
  SELECT source, n, unnest([1, 2, 3, 4]) AS rule, unnest([k1, k2, k3, k4]) AS k, unnest([0.6, 0.5, 0.5, 0.5]::double[]) AS most FROM hosts),
priors AS (SELECT rule, avg(k / n) AS m, var_samp(k / n) AS v FROM long GROUP BY rule),
weights AS (SELECT rule, m, CASE WHEN v > 0 AND m * (1 - m) > v THEN m * (1 - m) / v - 1 ELSE 1.0 END AS a FROM priors),
bad AS (SELECT source, bool_or((k + a * m) / (n + a) > most) AS bad FROM long JOIN weights USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT bad AS kept
FROM measures LEFT JOIN bad ON measures.source IS NOT DISTINCT FROM bad.source
"""


def _url_language_ratio() -> str:
    rule, says = "NULL", "NULL"
    for text, verdict in sorted(url_filter.RULES, key=lambda r: len(r[0])):
        name, slash, rest = text.partition("/")
        fits = f"(host = '{name}' OR suffix(host, '.{name}')) AND prefix(path, '{slash}{rest}')"
        rule, says = f"CASE WHEN {fits} THEN '{text}' ELSE {rule} END", f"CASE WHEN {fits} THEN '{verdict}' ELSE {says} END"
    order = url_filter.ORDER
    levels = []
    for k in range(order + 1):
        a, b = (f"CASE WHEN coalesce(na, 0) + coalesce(nb, 0) >= {url_filter.SUPPORT if k > 1 else 1} AND n{x} > 0 "
                f"THEN (coalesce({x}, 0) + k{x} * p{x}) / (n{x} + k{x})::double ELSE p{x} END AS p{x}" for x in "ab")
        below = f"JOIN m{k - 1} ON m{k - 1}.h = substr(g, 2)" if k else f"CROSS JOIN (SELECT 1.0::double / {url_filter.UNKNOWN} AS pa, 1.0::double / {url_filter.UNKNOWN} AS pb)"
        levels.append(f"""s{k} AS (SELECT substr(gram, {order - k + 1}, {k}) AS c, substr(gram, {order - k + 1}, {k + 1}) AS g,
  sum(n) FILTER (says = 'allow')::bigint AS a, sum(n) FILTER (says = 'block')::bigint AS b FROM grams GROUP BY ALL),
t{k} AS (SELECT c, sum(a)::bigint AS na, count(a) AS ka, sum(b)::bigint AS nb, count(b) AS kb FROM s{k} GROUP BY c),
m{k} AS (SELECT g AS h, {a}, {b} FROM s{k} JOIN t{k} USING (c) {below})""")
    return rf"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(regexp_extract(url, '://(.*)', 1, 's'), '^[^/?#]*(/[^?#]*)', 1, 's'), '') AS path,
         coalesce(regexp_extract(url, '://(.*)', 1, 's'), '') AS rest FROM pages),
rows AS (
  SELECT page_id, host, path, {rule} AS rule, {says} AS says, host || substr(rest, length(host) + 1) AS s FROM parts),
marked AS (SELECT *, {DIGEST.format('s')} % {url_filter.HELD_OUT} = 0 AS held FROM rows),
urls AS (SELECT s, CASE WHEN NOT held THEN says END AS says, count(*) AS n FROM marked GROUP BY ALL),
grams AS (
  SELECT says, sum(n) AS n, substr(repeat(chr({ord(url_filter.PAD)}), {order}) || s, i, {order + 1}) AS gram
  FROM (SELECT says, n, s, unnest(range(1, length(s) + 1)) AS i FROM urls) GROUP BY ALL),
{', '.join(levels)},
model AS (SELECT h AS gram, ln(pa) - ln(pb) AS ratio FROM m{order}),
places AS (
  SELECT s, substr(repeat(chr({ord(url_filter.PAD)}), {order}) || s, i, {order + 1}) AS gram
  FROM (SELECT s, unnest(range(1, length(s) + 1)) AS i FROM (SELECT DISTINCT s FROM rows))),
scores AS (SELECT s, round(avg(ratio), 6) AS score FROM places JOIN model USING (gram) GROUP BY s),
scored AS (SELECT marked.*, score FROM marked LEFT JOIN scores USING (s)),
bins AS (SELECT round(score, 3) AS bin, count(*) AS n FROM scored WHERE held AND says = 'allow' AND score IS NOT NULL GROUP BY 1),
cut AS (
  SELECT max(bin) AS most FROM (SELECT bin, sum(n) OVER (ORDER BY bin) - n AS below, sum(n) OVER () AS everything FROM bins)
  WHERE below <= {url_filter.MISSED} * everything)
SELECT page_id, host, path, rule,
       coalesce(says, CASE WHEN score IS NULL OR most IS NULL OR score >= most OR (SELECT count(*) FROM rows WHERE says = 'block') = 0
                      THEN 'allow' ELSE 'block' END) AS verdict
FROM scored, cut
"""


SOURCE_MIXING = f"""
WITH sized AS (SELECT doc_id, source, len({WORDS})::bigint AS size, md5(coalesce(text, '')) AS digest FROM documents),
totals AS (SELECT source, sum(size)::bigint AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [{', '.join(map(str, mixing.WEIGHTS))}][(turn % {len(mixing.WEIGHTS)} + 1)::int]::bigint AS w
  FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn FROM totals)),
rising AS (SELECT *, row_number() OVER (ORDER BY source_size * {mixing.MOST_REPEATS} / w, turn) AS k FROM weighed),
left_over AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(source_size * {mixing.MOST_REPEATS}) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS size_left,
         sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left FROM rising),
stops AS (SELECT *, size_left * w >= source_size * {mixing.MOST_REPEATS} * weight_left AS stopped FROM left_over),
level AS (SELECT arg_min(size_left, k) AS size_left, arg_min(weight_left, k) AS weight_left FROM stops WHERE NOT stopped),
goal AS (
  SELECT source, source_size, CASE WHEN stopped THEN (source_size * {mixing.MOST_REPEATS})::double
         ELSE (level.size_left * w)::double / level.weight_left::double END AS target
  FROM stops LEFT JOIN level ON true),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         {DIGEST.format(f"'{mixing.SEED}:' || coalesce(doc_id::varchar, 'null') || ':' || digest")} / 4294967296.0::double AS draw
  FROM sized JOIN goal ON sized.source IS NOT DISTINCT FROM goal.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::bigint AS taken
FROM rated
"""


def _license_scan() -> str:
    gaps = license_scan.GAPS.replace("'", "''")
    values = ", ".join(f"('{name}', '{text}', '{''.join(must)}')" for name, text, *must in license_scan.TEMPLATES)
    words = rf"regexp_split_to_array(lower(coalesce(text, '')), '[{gaps}]+')"
    pairs = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return rf"""
WITH templates AS (
  SELECT license, length, own, {pairs} AS must
  FROM (SELECT license, len(w) AS length, list_distinct({pairs}) AS own, list_filter({words.replace("text", "must")}, lambda x: x <> '') AS w
        FROM (SELECT license, must, list_filter({words}, lambda x: x <> '') AS w FROM (VALUES {values}) AS t(license, text, must)))),
longest AS (SELECT max(length) AS m FROM templates),
docs AS (SELECT doc_id, {pairs} AS h FROM (SELECT doc_id, {words} AS w FROM documents)),
windows AS (
  SELECT doc_id, list_distinct(h[greatest(a + 2 - m, 1):a + m + {license_scan.WINDOW}]) AS around
  FROM (SELECT doc_id, h, unnest(range(0, len(h), {license_scan.STRIDE})) AS a FROM docs), longest),
shares AS (SELECT doc_id, license, len(list_intersect(own, around)) / len(own) AS share FROM windows, templates
           WHERE list_has_all(around, must))
SELECT doc_id, license, max(share) AS containment FROM shares WHERE share >= {license_scan.LIMIT} GROUP BY ALL
"""


NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM words WHERE len(w) > 1)
  UNION ALL SELECT doc_id, w[1] FROM words WHERE len(w) = 1),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, b FROM reach JOIN both_ways ON a = other)
SELECT doc_id, coalesce(n, 0)::bigint AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""

CODED = ("replace(replace(replace(replace({0}, chr(92), chr(92) || 'b'), '#', chr(92) || 'h'), '<', chr(92) || 'l'), ':', chr(92) || 'c')")
CHAT_FORMAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::bigint AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('### : </turn>' || chr(10)) + length({CODED.format('role')}) + length({CODED.format('text')}))::bigint AS formatted_chars,
       regexp_full_match(string_agg(role, chr(1) ORDER BY turn NULLS FIRST, role, text), '(system\x01)?(user\x01assistant\x01)*user\x01assistant') AS valid
FROM turns GROUP BY conv_id
"""

PHRASES = rf"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS k))),
counted AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w))::bigint AS n FROM pieces GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, n, string_split(phrase, ' ') AS w FROM counted JOIN totals USING (lang) WHERE k > 1),
cuts AS (
  SELECT c.lang, c.k, c.phrase, a, n, cut, l.f AS l, r.f AS r, (1000::hugeint * a * n) // (l.f::hugeint * r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN counted l ON l.lang = c.lang AND l.k = cut AND l.phrase = array_to_string(w[1:cut], ' ')
  JOIN counted r ON r.lang = c.lang AND r.k = c.k - cut AND r.phrase = array_to_string(w[cut + 1:], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT DISTINCT i.lang, array_to_string(i.w[spot:spot + size - 1], ' ') AS phrase, i.a
  FROM (SELECT *, unnest(range(1, k - size + 2)) AS spot FROM (SELECT *, unnest(range(2, k)) AS size FROM candidates WHERE k > 2)) i),
dropped AS (SELECT lang, phrase, max(a) AS most FROM longer GROUP BY ALL),
kept AS (SELECT s.* FROM scored s LEFT JOIN dropped d ON d.lang = s.lang AND d.phrase = s.phrase WHERE most IS NULL OR 100 * most < 100 * a)
SELECT lang, rank, phrase, a, l, r, n, score::bigint AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
WHERE rank <= 2000"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::double)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, list_inner_product(a.e, b.e)::bigint AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
         (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id))::int AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""

ORACLES = {
    "op1_host_quality_rules": HOST_QUALITY_RULES,
    "op2_url_language_ratio": _url_language_ratio(),
    "op5_source_mixing": SOURCE_MIXING,
    "op6_license_scan": _license_scan(),
    "op8_bottom_k_near_duplicates": NEAR_DUPLICATES,
    "op9_chat_format": CHAT_FORMAT,
    "op11_phrase_collocations": PHRASES,
    "op12_cover_tree_negatives": HARD_NEGATIVES,
}
