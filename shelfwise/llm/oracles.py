"""DuckDB SQL for the queries whose rows SQL can state."""

from __future__ import annotations

LINE_PARTS = r"""
lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
often AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
"""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM_WORDS = "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SPACE_WORDS = "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x20\x09-\x0D]+')"

RULES = [("block", "net/es/"), ("block", "net/fr/"), ("allow", "www.example.com/en/"), ("block", "example.com/en/"), ("allow", "com/")]
_FITS = [(f"((host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}'))", v, r)
         for v, r in sorted(RULES, key=lambda x: -len(x[1]))]
RULE = "CASE " + " ".join(f"WHEN {f} THEN '{r}'" for f, _, r in _FITS) + " END"
SAID = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, v, _ in _FITS) + " END"
#: Strength of the prior at one level, by moments.
LEVEL = """
{name}_level AS (
  SELECT CASE WHEN rho > 0 THEN greatest(1.0, least(1000.0, 1 / greatest(rho, 1e-9) - 1)) ELSE 1000.0 END AS strength
  FROM (SELECT CASE WHEN room > 0 THEN (s - w * (k - 1)) / room END AS rho
    FROM (SELECT p * (1 - p) AS w, k, s, p * (1 - p) * (total - squares / total - k + 1) AS room
      FROM (SELECT any_value(total) AS total, any_value(p) AS p, any_value(k) AS k, any_value(squares) AS squares, sum(n * pow(bad / n - p, 2)) AS s
        FROM {groups}, (SELECT CAST(sum(n) AS DOUBLE) AS total, sum(bad) / sum(n) AS p, count(*) AS k, CAST(sum(n * n) AS DOUBLE) AS squares FROM {groups} WHERE n > 0)
        WHERE n > 0)))),"""

#: CRC-32 of the ASCII text k, with the table ``tab``.
CRC_TABLE = """list_transform(range(256), lambda n: list_reduce(list_prepend(CAST(n AS UBIGINT), list_transform(range(8), lambda j: CAST(j AS UBIGINT))),
  lambda c, j: CASE WHEN c & 1 = 1 THEN xor(CAST(3988292384 AS UBIGINT), c >> 1) ELSE c >> 1 END))"""
CRC = """xor(CAST(4294967295 AS UBIGINT), list_reduce(
  list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS UBIGINT))),
  lambda acc, b: xor(acc >> 8, tab[CAST(xor(acc, b) & 255 AS INTEGER) + 1])))"""

ORACLES = {
    "op1_line_dedup": f"""
WITH {LINE_PARTS}
SELECT doc_id, count(*) AS n_lines, count(often.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (often.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN often ON keyed.key = often.key
GROUP BY doc_id
""",
    "op9_decontamination": f"""
WITH items AS (SELECT item_id, {ALNUM_WORDS} AS w FROM benchmark),
spans AS (
  SELECT item_id, list_slice(w, i, i + least(10, len(w)) - 1) AS win, least(10, len(w)) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {ALNUM_WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM docs CROSS JOIN (SELECT DISTINCT n FROM spans) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, places.n, item_id FROM places JOIN spans ON places.n = spans.n AND places.win = spans.win),
words AS (SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id),
-- the longest match: windows that follow one another in item and document
chains AS (
  SELECT doc_id, n, item_id, pos - i AS line, i - row_number() OVER (PARTITION BY doc_id, item_id, pos - i ORDER BY i) AS grp
  FROM (SELECT DISTINCT doc_id, places.n, places.i, s.item_id, s.pos FROM places JOIN (
    SELECT item_id, list_slice(w, i, i + least(10, len(w)) - 1) AS win, least(10, len(w)) AS n, i AS pos
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)) s
    ON places.n = s.n AND places.win = s.win)),
longest AS (SELECT doc_id, max(m) AS longest_words
  FROM (SELECT doc_id, count(*) - 1 + max(n) AS m FROM chains GROUP BY doc_id, item_id, line, grp) GROUP BY doc_id)
SELECT docs.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(longest_words, 0) AS longest_words
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN longest USING (doc_id)
""",
    "op6_near_dedup": f"""
WITH RECURSIVE docs AS (SELECT doc_id, {SPACE_WORDS} AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 2) AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * inter >= 85 * (x.n + y.n - inter)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
grouped AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT docs.doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = docs.doc_id AS kept
FROM docs JOIN grouped USING (doc_id) LEFT JOIN sizes USING (doc_id)
""",
    "op5_url_filter": f"""
WITH rest AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, regexp_extract(r, '^[^/?#]*') AS h, r FROM rest),
split AS (SELECT page_id, {LOWER.format("h")} AS host, regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM parts),
hosts AS (
  SELECT host, count(quality) AS n, count(*) FILTER (quality = 0) AS bad,
    array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain, string_split(host, '.')[-1] AS suffix
  FROM split LEFT JOIN labels ON doc_id = page_id GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
overall AS (SELECT (sum(bad) + 0.5) / (sum(n) + 1) AS prior FROM suffixes),
{LEVEL.format(name="suffix", groups="suffixes")}
{LEVEL.format(name="domain", groups="domains")}
{LEVEL.format(name="host", groups="hosts")}
suffix_share AS (SELECT suffix, (bad + strength * prior) / (n + strength) AS prior FROM suffixes, overall, suffix_level),
domain_share AS (SELECT domain, (bad + strength * prior) / (n + strength) AS prior FROM domains JOIN suffix_share USING (suffix), domain_level),
host_share AS (SELECT host, n, strength, (bad + strength * prior) / (n + strength) AS share FROM hosts JOIN domain_share USING (domain), host_level)
SELECT page_id, host, path, {RULE} AS rule,
  coalesce({SAID}, CASE WHEN share - 1.645 * sqrt(share * (1 - share) / (n + strength + 1)) > 0.15 THEN 'block' ELSE 'allow' END) AS verdict
FROM split JOIN host_share USING (host)
""",
    "op12_collocations": f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex({LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
spans AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
phrases AS (
  SELECT lang, list_slice(w, i, i + m - 1) AS p FROM (
    SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM spans, (VALUES (1), (2), (3)) AS t(m) WHERE len(w) >= m)),
counts AS MATERIALIZED (SELECT lang, p, array_to_string(p, ' ') AS phrase, CAST(count(*) AS HUGEINT) AS f FROM phrases GROUP BY lang, p),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE len(p) = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT lang || ':' || phrase AS id, lang, p, phrase, f FROM counts WHERE f >= 10),
parts AS MATERIALIZED (
  SELECT id, lang, phrase, a, k, lang || ':' || array_to_string(list_slice(p, 1, k), ' ') AS first, lang || ':' || array_to_string(list_slice(p, k + 1, len(p)), ' ') AS rest
  FROM (SELECT id, lang, phrase, p, f AS a, unnest(range(1, len(p))) AS k FROM often WHERE len(p) > 1)),
cuts AS (
  SELECT parts.id, parts.lang, parts.phrase, a, k, l.f AS l, r.f AS r, (1000000 * a * a) // (l.f * r.f) AS score
  FROM parts JOIN often l ON l.id = parts.first JOIN often r ON r.id = parts.rest
  QUALIFY row_number() OVER (PARTITION BY parts.id ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT s.id FROM often s JOIN (
    SELECT lang || ':' || array_to_string(list_slice(p, 1, len(p) - 1), ' ') AS id, f AS longer FROM often WHERE len(p) > 1
    UNION ALL SELECT lang || ':' || array_to_string(list_slice(p, 2, len(p)), ' '), f FROM often WHERE len(p) > 1) x ON x.id = s.id
  WHERE 100 * longer >= 50 * s.f),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM cuts WHERE id NOT IN (SELECT id FROM inside))
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) WHERE rank <= 2000
""",
    "op13_conversation_repair": f"""
WITH RECURSIVE tab AS (SELECT {CRC_TABLE} AS tab),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hit AS (SELECT raw.*, {CRC} % 20 AS f FROM raw, tab),
damaged AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hit, range(2) AS copies(c) WHERE f <> 0 AND (c = 0 OR f = 3)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
seen AS (
  SELECT *, substr(role, 1, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS copy,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    count(*) OVER (PARTITION BY conv_id) AS size
  FROM numbered),
marked AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN copy > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM seen),
-- insertions before a row: from a state to a state
added(state, n, reached, lines) AS (VALUES
  (0, 0, 0, []), (0, 1, 2, ['user:']), (0, 2, 3, ['user:', 'assistant:']), (1, 0, 1, []), (1, 1, 2, ['user:']), (1, 2, 3, ['user:', 'assistant:']),
  (2, 0, 2, []), (2, 1, 3, ['assistant:']), (3, 0, 3, []), (3, 1, 2, ['user:'])),
closed(state, n, lines) AS (VALUES (0, 0, []), (1, 2, ['user:', 'assistant:']), (2, 1, ['assistant:']), (3, 0, [])),
-- what a row may become: its edit, whether its own role is needed, the role it gets, its cost
moves(state, edit, initial, role, reached, price) AS (VALUES
  (0, 'K', 's', NULL, 1, 0), (0, 'K', 'u', NULL, 2, 0), (1, 'K', 'u', NULL, 2, 0), (2, 'K', 'a', NULL, 3, 0), (3, 'K', 'u', NULL, 2, 0),
  (0, 'R', NULL, 'user', 2, 1), (1, 'R', NULL, 'user', 2, 1), (2, 'R', NULL, 'assistant', 3, 1), (3, 'R', NULL, 'user', 2, 1),
  (0, 'D', NULL, NULL, 0, 2), (1, 'D', NULL, NULL, 1, 2), (2, 'D', NULL, NULL, 2, 2), (3, 'D', NULL, NULL, 3, 2)),
way(conv_id, i, state, cost, audit, lines) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, 0, '', CAST([] AS VARCHAR[]) FROM numbered
  UNION ALL
  SELECT conv_id, i, state, cost, audit, lines FROM (
    SELECT way.conv_id, m.i, v.reached AS state,
      way.cost + 5 * a.n + v.price + CASE WHEN m.fault = 'truncated' AND v.edit <> 'D' THEN 5 ELSE 0 END AS cost,
      way.audit || repeat('I', a.n) || v.edit AS audit,
      list_concat(way.lines, a.lines, CASE WHEN v.edit = 'D' THEN [] ELSE [coalesce(v.role, m.role) || ':' || m.text] END) AS lines
    FROM way JOIN marked m ON m.conv_id IS NOT DISTINCT FROM way.conv_id AND m.i = way.i + 1
      JOIN added a ON a.state = way.state
      JOIN moves v ON v.state = a.reached AND (v.initial IS NULL OR v.initial = m.initial) AND (v.edit = 'D' OR m.fault NOT IN ('blank', 'duplicate')))
  QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1),
ended AS (
  SELECT way.conv_id, cost + 5 * closed.n AS cost, audit || repeat('I', closed.n) AS audit, list_concat(way.lines, closed.lines) AS lines
  FROM way JOIN (SELECT DISTINCT conv_id, size FROM marked) s ON s.conv_id IS NOT DISTINCT FROM way.conv_id AND s.size = way.i JOIN closed USING (state)
  QUALIFY row_number() OVER (PARTITION BY way.conv_id ORDER BY cost + 5 * closed.n, audit || repeat('I', closed.n)) = 1),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ids.conv_id
  LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM ids.conv_id
""",
}
