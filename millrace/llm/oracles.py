"""SQL with the results of those queries that SQL can express on whole tables."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

OP10 = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents
), grams AS (
  SELECT doc_id, list_transform(generate_series(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS g FROM w WHERE len(ws) > 2
), places AS (
  SELECT doc_id, unnest(g) AS gram, generate_subscripts(g, 1) AS i FROM grams
), twice AS (
  SELECT doc_id, unnest(list_distinct(flatten(list(list_concat(places_, list_transform(places_, lambda x: x + 1), list_transform(places_, lambda x: x + 2)))))) AS i
  FROM (SELECT doc_id, gram, list(i) AS places_ FROM places GROUP BY doc_id, gram HAVING count(*) > 1) GROUP BY doc_id
), again AS (
  SELECT doc_id, count(*) AS n FROM twice GROUP BY doc_id
), c AS (
  SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(again.n, 0) AS n_repeat_words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines,
    strlen(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_bytes,
    strlen(regexp_replace(t, '[\x00-@\[-`\{{-\x7F]', '', 'g')) AS letter_bytes
  FROM w LEFT JOIN again USING (doc_id)
), f AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 4 * n_symbols <= n_words
    AND 2 * letter_bytes >= word_bytes AND 10 * n_dup_lines <= 3 * len(lines) AS kept
FROM f
"""


_REST = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP9 = rf"""
WITH p AS (
  SELECT page_id, url, html, coalesce({_LOWER.format(f"regexp_extract({_REST}, '^([^/?#]*)', 1, 's')")}, '') AS host,
    coalesce(regexp_extract({_REST}, '^[^/?#]*([^?#]*)', 1, 's'), '') AS path,
    coalesce(regexp_extract({_REST}, '^[^?#]*\?([^#]*)', 1, 's'), '') AS query
  FROM pages
), k AS (
  SELECT *, array_to_string(list_sort(list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(ref|utm_[a-z]+)(=|$)'))), '&') AS q FROM p
), c AS (
  SELECT *, CASE WHEN instr(url, '://') > 0 THEN {_LOWER.format("substr(url, 1, instr(url, '://') - 1)")} || '://'
    || regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':(80|443)?$', ''), '^www\.', '')
    || regexp_replace(path, '/+$', '') || CASE WHEN q = '' THEN '' ELSE '?' || q END END AS canonical FROM k
), listed AS (
  SELECT DISTINCT canonical FROM c WHERE canonical IS NOT NULL AND len(regexp_extract_all(regexp_extract(html, '<title>([^<]*)</title>', 1, 's'), '[#%$*&]{{3}}')) >= 3
), r AS (
  SELECT c.*, listed.canonical IS NOT NULL AS listed, CASE
    WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/' END AS rule
  FROM c LEFT JOIN listed ON c.canonical = listed.canonical
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed FROM r
"""


OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(generate_series(1, len(ws) - 4), lambda i: hash(array_to_string(ws[i:i + 4], ' '))))
    WHEN len(ws) > 0 THEN [hash(array_to_string(ws, ' '))] ELSE [] END AS sh FROM w
), u AS (
  SELECT doc_id, unnest(sh) AS x FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * c >= 75 * (len(x.sh) + len(y.sh) - c)
), reach AS (
  SELECT doc_id, doc_id AS r FROM s UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.r
)
SELECT doc_id, len(any_value(sh))::BIGINT AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept FROM reach JOIN s USING (doc_id) GROUP BY doc_id
"""


def _joined(windows: str) -> str:
    """Overlapping or adjoining windows (doc_id, s, e) of a document joined."""
    return f"""SELECT doc_id, min(s) AS s, max(e) AS e FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM (
      SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS new FROM ({windows}))) GROUP BY doc_id, g"""


OP7 = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents
), g AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 49)) AS i FROM w)
), r AS (
  SELECT h, min(doc_id) AS f FROM g GROUP BY h HAVING min(doc_id) <> max(doc_id)
), m AS (
  SELECT doc_id, i - 1 AS s, i + 49 AS e, f < doc_id AS later FROM g JOIN r USING (h)
), a AS ({_joined("SELECT doc_id, s, e FROM m")}), b AS ({_joined("SELECT doc_id, s, e FROM m WHERE later")})
SELECT doc_id, s::BIGINT AS start_word, e::BIGINT AS end_word, (e - s)::BIGINT AS n_words,
  coalesce((SELECT sum(least(b.e, a.e) - greatest(b.s, a.s)) FROM b WHERE b.doc_id = a.doc_id AND b.s < a.e AND b.e > a.s), 0)::BIGINT AS n_removed FROM a
"""


def _op2() -> str:
    from .license_scan import THRESHOLD, WORD
    from .license_texts import TEMPLATES

    quoted = ",".join(f"({i}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for i, (name, text) in enumerate(TEMPLATES))
    tokens = lambda c: f"regexp_extract_all({_LOWER.format(c)}, '{WORD}')"
    flat = lambda c: rf"regexp_replace({c}, '\s*\n[ \t]*([#*;%]+|//+|--+)?[ \t]*', ' ', 'g')"
    return rf"""
WITH t(i, license, txt) AS (VALUES {quoted}), tw AS (
  SELECT i, license, w, count(*) AS tf FROM (SELECT i, license, unnest({tokens("txt")}) AS w FROM t) GROUP BY 1, 2, 3
), idf AS (
  SELECT w, ln(1 + (SELECT count(*) FROM t) / count(*)) AS x FROM tw GROUP BY w
), tv AS (
  SELECT i, license, w, tf * x / sqrt(sum(tf * x * tf * x) OVER (PARTITION BY i)) AS v FROM tw JOIN idf USING (w)
), f AS (
  SELECT doc_id, text, concat_ws('/', source, lang) AS dir, regexp_matches(split_part(coalesce(text, ''), chr(10), 1), '[Ll]icen[cs]e|[Cc]opyright') AS lic FROM documents
), p AS (
  SELECT doc_id, dir, lic, concat_ws('/', dir, CASE WHEN lic THEN 'LICENSE-' || doc_id ELSE doc_id || '.txt' END) AS path,
    list_concat(string_split_regex(text, '\n|[.!?] +'), list_transform(string_split_regex(text, '\n[ \t#*;%/\-]*\n'), lambda x: {flat("x")}),
      CASE WHEN lic THEN [{flat("text")}] ELSE [] END) AS seg FROM f
), u AS (
  SELECT doc_id, unnest(list_distinct(seg)) AS s FROM p
), d AS (
  SELECT s, w, count(*) AS tf FROM (SELECT s, unnest({tokens("s")}) AS w FROM (SELECT DISTINCT s FROM u)) GROUP BY 1, 2
), v AS (
  SELECT s, d.w, tf * coalesce(x, ln(1 + (SELECT count(*) FROM t))) AS v FROM d LEFT JOIN idf USING (w)
), norm AS (
  SELECT s, sqrt(sum(v * v)) AS n FROM v GROUP BY s
), c AS (
  SELECT s, license, round(sum(v.v * tv.v) / any_value(n), 6) AS score FROM v JOIN tv USING (w) JOIN norm USING (s) GROUP BY s, i, license
), own AS (
  SELECT doc_id, license, score FROM u JOIN c USING (s) WHERE score >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY license = 'proprietary', score DESC, license) = 1
), given AS (
  SELECT dir, license FROM (SELECT dir, license, count(*) AS n FROM p JOIN own USING (doc_id) WHERE lic GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY n DESC, license) = 1
), above AS (
  SELECT DISTINCT of, k, array_to_string(parts[1:k], '/') AS dir FROM (SELECT dir AS of, string_split(dir, '/') AS parts, unnest(generate_series(0, len(string_split(dir, '/')))) AS k FROM p)
), nearest AS (
  SELECT of, above.dir AS license_dir, license AS got FROM above JOIN given ON above.dir = given.dir QUALIFY row_number() OVER (PARTITION BY of ORDER BY k DESC) = 1
)
SELECT doc_id, path, coalesce(own.license, got) AS license, score, CASE WHEN own.license IS NOT NULL THEN 'own' WHEN got IS NOT NULL THEN 'inherited' END AS origin,
  CASE WHEN own.license IS NULL THEN license_dir END AS license_dir FROM p LEFT JOIN own USING (doc_id) LEFT JOIN nearest ON p.dir = nearest.of
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_license_scan": _op2(), "op1_minhash_dedup": OP1, "op7_suffix_dedup": OP7, "op9_url_filter": OP9, "op10_quality_rules": OP10}
