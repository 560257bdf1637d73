"""SQL for queries whose rows it can express, on tables small enough for it."""

OP6_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, s, array_to_string(ws[s + 1:s + 20], ' ') AS seq
            FROM (SELECT doc_id, ws, unnest(range(greatest(len(ws) - 19, 0))) AS s FROM w)),
again AS (SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY seq ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, pos FROM (SELECT doc_id, unnest(range(s, s + 20)) AS pos FROM again)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS txt FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(txt, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[s + 1:s + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(CASE WHEN len(ws) = 0 THEN 0 ELSE greatest(len(ws) - 3, 1) END)) AS s FROM w)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS o FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM shared JOIN sizes x ON u = x.doc_id JOIN sizes y ON v = y.doc_id WHERE 100 * o >= 85 * (x.n + y.n - o)),
reach AS (SELECT DISTINCT u AS a, u AS b FROM links UNION SELECT reach.a, links.v FROM reach JOIN links ON reach.b = links.u),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, coalesce(b, w.doc_id) AS component_id
FROM w LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON a = w.doc_id
"""

OP3_SQL = r"""
WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
triples AS (SELECT doc_id, s, array_to_string(ws[s + 1:s + 3], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(greatest(len(ws) - 2, 0))) AS s FROM w)),
often AS (SELECT doc_id, s FROM triples QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (SELECT doc_id, count(DISTINCT pos) AS r FROM (SELECT doc_id, unnest(range(s, s + 3)) AS pos FROM often) GROUP BY doc_id),
m AS (
  SELECT doc_id, lang, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_capitals, length(t) - length(replace(t, '!', '')) AS n_shouts,
    len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS n_lines,
    len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_different,
    coalesce(r, 0) AS n_repeat_words
  FROM w LEFT JOIN repeats USING (doc_id)),
scored AS (
  SELECT *, n_lines - n_different AS n_dup_lines, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN [1000 * n_symbols // word_chars, 1000 * (n_lines - n_different) // n_lines, 1000 * n_repeat_words // n_words,
                                1000 * n_capitals // word_chars, 1000 * n_shouts // n_words] ELSE [0, 0, 0, 0, 0] END AS scores
  FROM m),
levelled AS (
  SELECT *, len(list_filter([900, 800, 700, 600, 500, 400, 300, 250, 200, 150, 100, 75, 50, 30], lambda c:
    scores[1] <= c * 500 // 1000 AND scores[2] <= c AND scores[3] <= c AND scores[4] <= c AND scores[5] <= c * 500 // 1000))::INT AS passed FROM scored),
good AS (SELECT coalesce(lang, '*') AS stratum, passed, base_failed FROM levelled JOIN labels USING (doc_id) WHERE quality = 1),
own AS (SELECT stratum FROM good WHERE stratum <> '*' AND NOT base_failed GROUP BY stratum ORDER BY count(*) DESC, stratum LIMIT 256),
named AS (SELECT coalesce(own.stratum, '*') AS stratum, passed, base_failed FROM good LEFT JOIN own USING (stratum)),
tests AS (
  SELECT stratum, nth, count(*) FILTER (NOT base_failed) AS n, count(*) FILTER (NOT base_failed AND passed < nth) AS k, $RISK AS p
  FROM named, (SELECT unnest(range(1, 15)) AS nth) GROUP BY ALL),
judged AS (
  SELECT *, n > 0 AND k <= n * p AND list_sum(list_transform(range(CASE WHEN k <= n * p THEN k + 1 ELSE 1 END), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(p) + (n - i) * ln(1 - p)))) <= 0.05 / (SELECT count(DISTINCT stratum) FROM named) AS ok
  FROM tests),
levels AS (SELECT stratum, (coalesce(min(nth) FILTER (NOT ok), 15) - 1)::INT AS level FROM judged GROUP BY stratum),
final AS (
  SELECT levelled.*, coalesce(a.level, b.level, 0) AS level FROM levelled LEFT JOIN levels a ON levelled.lang = a.stratum LEFT JOIN levels b ON b.stratum = '*')
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND passed >= level AS kept, lang AS stratum, passed, level
FROM final
"""


def op3_sql(risk: float) -> str:
    return OP3_SQL.replace("$RISK", f"{risk}::DOUBLE")


#: The base patterns as they are given, for an RE2 engine.
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_found = " UNION ALL ".join(f"SELECT doc_id, {i} AS k, '{kind}' AS kind, regexp_extract_all(t, '{p}') AS f, regexp_split_to_array(t, '{p}') AS g FROM d" for i, (kind, p) in enumerate(PII_PATTERNS.items()))
PII_BASE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({_found}),
u AS (SELECT doc_id, k, kind, unnest(f) AS x, unnest(g[1:len(f)]) AS gap, unnest(range(len(f))) AS i FROM m),
s AS (SELECT *, sum(length(gap) + length(x)) OVER (PARTITION BY doc_id, k ORDER BY i)::BIGINT AS e, regexp_replace(x, '[^0-9]', '', 'g') AS n FROM u),
ok AS (
  SELECT doc_id, k, e - length(x) AS b, kind || ':' || (e - length(x)) || ':' || e AS span FROM s
  WHERE k = 0
     OR k = 1 AND list_bool_and(list_transform(string_split(x, '.'), lambda p: length(ltrim(p, '0')) < 3 OR (length(ltrim(p, '0')) = 3 AND ltrim(p, '0') <= '255')))
     OR k = 2 AND length(n) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(n) + 1), lambda i: CASE WHEN i % 2 = 1 THEN n[length(n) + 1 - i]::INT ELSE 2 * n[length(n) + 1 - i]::INT // 10 + 2 * n[length(n) + 1 - i]::INT % 10 END)) % 10 = 0
     OR k = 3 AND length(n) BETWEEN 8 AND 15)
SELECT doc_id, count(*) FILTER (k = 0) AS n_email, count(*) FILTER (k = 1) AS n_ip, count(*) FILTER (k = 2) AS n_card, count(*) FILTER (k = 3) AS n_phone,
  sha256(coalesce(string_agg(span, ',' ORDER BY k, b), '')) AS base_sha256
FROM d LEFT JOIN ok USING (doc_id) GROUP BY doc_id
"""

TARGETS_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
-- Each step fills the sources that their weight gives more than twice their size; the rest of the words goes on to the others.
steps AS (
  SELECT 0 AS step, source, source_size, w, false AS filled FROM sources
  UNION ALL
  SELECT step + 1, source, source_size, w,
    filled OR w * (1.5 * sum(source_size) OVER () - sum(CASE WHEN filled THEN 2 * source_size ELSE 0 END) OVER ()) / nullif(sum(CASE WHEN filled THEN 0 ELSE w END) OVER (), 0) > 2 * source_size
  FROM steps WHERE step < (SELECT count(*) FROM sources)),
last AS (SELECT *, (1.5 * sum(source_size) OVER () - sum(CASE WHEN filled THEN 2 * source_size ELSE 0 END) OVER ()) / nullif(sum(CASE WHEN filled THEN 0 ELSE w END) OVER (), 0) AS level
         FROM steps WHERE step = (SELECT max(step) FROM steps))
SELECT doc_id, size, source_size, round((CASE WHEN filled THEN 2.0 * source_size ELSE w * level END)::DOUBLE, 3) AS target
FROM d JOIN last ON d.source IS NOT DISTINCT FROM last.source
"""
