"""Identifiers, citations, references, structure and formulas, over documents enriched alike in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identifiers as I
from ..operators import citations as C
from ..operators import formulas as M
from ..operators import layout as L
from ..operators import structure as S
from .registry import query, table
from .texts import _STRIP

#: Spark SQL and DuckDB read this expression alike.
_TAIL = (
    "concat('\\n', 'Introduction', '\\n', 'As [', cast(doc_id % 40 + 1 as string), '] and [2,3] show, Figure ', cast(doc_id % 5 as string), ' holds. ', 'doi:10.', cast(1000 + doc_id % 9000 as string), '/x.', cast(doc_id as string), ', arXiv:2', "
    "lpad(cast(doc_id % 1000 as string), 3, '0'), '.', lpad(cast(doc_id % 100000 as string), 5, '0'), 'v', cast(doc_id % 3 + 1 as string), ' see https://github.com/u/r', cast(doc_id as string), ', ISBN 978-3-16-148410-', cast(doc_id % 10 as string), "
    "' 0000-0002-1825-009', cast(doc_id % 10 as string), '\\n', 'Figure ', cast(doc_id % 5 as string), ': A plot of $x_', cast(doc_id as string), ' = y$.', '\\n', 'References', '\\n', '[1] A. Author, B. Writer. \"A title of note\". 20', lpad(cast(doc_id % 25 as string), 2, '0'), "
    "'. doi:10.1234/abc', '\\n', '[2] C. Third. Another work of some length. 1999.')"
)
_SQL_TAIL = _TAIL.replace("'\\n'", "chr(10)").replace("as string", "as varchar")
_E = f"(SELECT doc_id, concat(text, {_SQL_TAIL}) AS text FROM documents)"


def enriched(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a tail; a missing text is the tail alone, as SQL's concat has it."""
    return table(spark, d, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.expr(_TAIL)).alias("text"))


@query(r"SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}')) AS email FROM documents")
def email_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.explode(I.emails(F.col("text"))).alias("email"))


@query(r"""SELECT type, count(*) AS n FROM (SELECT CASE WHEN contains(u, 'arxiv.org') THEN 'arxiv' WHEN contains(u, 'doi.org') THEN 'doi' WHEN contains(u, 'github.com') THEN 'github' WHEN regexp_matches(u, '\.pdf([?#]|$)') THEN 'pdf'
  WHEN regexp_matches(u, 'ieee|acm\.org|springer|sciencedirect|nature\.com') THEN 'journal' ELSE 'general' END AS type FROM (SELECT lower(url) AS u FROM pages)) GROUP BY type""")
def url_types(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").groupBy(I.url_type(F.col("url")).alias("type")).agg(F.count(F.lit(1)).alias("n"))


@query(rf"SELECT DISTINCT doc_id, doi, length(doi) >= 8 AS valid FROM (SELECT doc_id, regexp_replace(unnest(regexp_extract_all(text, '10\.[0-9]{{4,9}}/[A-Za-z0-9._;()/:\-]+')), '[.,;:)]+$', '') AS doi FROM {_E})")
def doi_extract(spark: SparkSession, d: str) -> DataFrame:
    return enriched(spark, d).select("doc_id", F.explode(I.dois(F.col("text"))).alias("doi")).withColumn("valid", I.doi_valid(F.col("doi")))


@query(rf"""SELECT doc_id, id, CASE WHEN contains(id, 'v') THEN 'new_versioned' ELSE 'new' END AS kind, 2000 + CAST(substr(id, 1, 2) AS INT) AS year FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, 'arXiv:([0-9]{{4}}\.[0-9]{{4,5}}(?:v[0-9]+)?)', 1)) AS id FROM {_E})""")
def arxiv_extract(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("id")
    return enriched(spark, d).select("doc_id", F.explode(I.arxiv_ids(F.col("text"))).alias("id")).select("doc_id", "id", I.arxiv_kind(i).alias("kind"), I.arxiv_year(i).alias("year"))


@query(rf"SELECT doc_id, isbn, CASE length(isbn) WHEN 13 THEN 'ISBN-13' WHEN 10 THEN 'ISBN-10' ELSE 'unknown' END AS type FROM (SELECT DISTINCT doc_id, replace(unnest(regexp_extract_all(text, 'ISBN(?:-1[03])?:? *([0-9][0-9\-]{{8,15}}[0-9Xx])', 1)), '-', '') AS isbn FROM {_E})")
def isbn_extract(spark: SparkSession, d: str) -> DataFrame:
    return enriched(spark, d).select("doc_id", F.explode(I.isbns(F.col("text"))).alias("isbn")).withColumn("type", I.isbn_type(F.col("isbn")))


@query(rf"SELECT DISTINCT doc_id, o AS orcid, right(o, 1) = '7' AS valid FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]{{4}}-[0-9]{{4}}-[0-9]{{4}}-[0-9]{{3}}[0-9X]')) AS o FROM {_E}) WHERE starts_with(o, '0000-0002-1825-009')")
def orcid_check(spark: SparkSession, d: str) -> DataFrame:
    o = enriched(spark, d).select("doc_id", F.explode(I.orcids(F.col("text"))).alias("orcid")).where(F.startswith("orcid", F.lit("0000-0002-1825-009")))
    return o.withColumn("valid", I.orcid_valid(F.col("orcid")))


@query(rf"SELECT doc_id, len(list_distinct(regexp_extract_all(text, 'https?://[^ \t\n\r<>\"{{}}|\\^`\[\]]+'))) AS n_urls, len(list_distinct(regexp_extract_all(text, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{{2,}}'))) AS n_emails FROM {_E}")
def identifier_totals(spark: SparkSession, d: str) -> DataFrame:
    return enriched(spark, d).select("doc_id", I.identifiers(F.col("text")).alias("i")).select("doc_id", F.size("i.urls").cast("long").alias("n_urls"), F.size("i.emails").cast("long").alias("n_emails"))


_MARKS = r"regexp_extract_all(text, '\[[0-9]+(?:[, \t\n\r\f\-][0-9]+)*\]|\([0-9]+(?:[, \t\n\r\f\-][0-9]+)*\)')"
#: Marks without a number from 1 to 1000 are no citations.
_CITES = r"len(list_filter(regexp_extract_all(mark, '[0-9]+'), lambda x: coalesce(TRY_CAST(x AS BIGINT), 0) BETWEEN 1 AND 1000)) > 0"


@query(f"SELECT doc_id, place - 1 AS place, mark FROM (SELECT doc_id, unnest({_MARKS}) AS mark, generate_subscripts({_MARKS}, 1) AS place FROM {_E}) WHERE {_CITES}")
def citation_mentions(spark: SparkSession, d: str) -> DataFrame:
    return C.citations(enriched(spark, d)).select("doc_id", "place", "mark")


@query(f"SELECT doc_id, n, count(*) AS k FROM (SELECT doc_id, unnest(list_transform(regexp_extract_all(mark, '[0-9]+'), lambda x: CAST(x AS BIGINT))) AS n FROM (SELECT doc_id, unnest({_MARKS}) AS mark FROM {_E})) WHERE n BETWEEN 1 AND 1000 GROUP BY doc_id, n")
def citation_numbers(spark: SparkSession, d: str) -> DataFrame:
    c = C.citations(enriched(spark, d)).select("doc_id", F.explode("numbers").alias("n"))
    return c.groupBy("doc_id", F.col("n").cast("long").alias("n")).agg(F.count(F.lit(1)).alias("k"))


@query(f"SELECT doc_id, mark, (instr(text, mark) - 1)::BIGINT AS start, (instr(text, mark) - 1 + length(mark))::BIGINT AS \"end\" FROM (SELECT DISTINCT doc_id, text, unnest({_MARKS}) AS mark FROM {_E})")
def citation_first_span(spark: SparkSession, d: str) -> DataFrame:
    # by text too: SQL keeps texts of one doc_id apart
    chunks = enriched(spark, d).select(F.struct("doc_id", F.md5("text")).alias("doc"), F.lit(0).alias("chunk_index"), "text")
    return C.first_spans(chunks, "doc").select("doc.doc_id", "mark", "start", "end")


@query(f"""SELECT doc_id, '1' AS ref_id, 2000 + (doc_id % 25)::INT AS year, 'A title of note' AS title, '10.1234/abc' AS doi FROM {_E} UNION ALL SELECT doc_id, '2', 1999, 'Another work of some length', NULL FROM {_E}""")
def reference_entries(spark: SparkSession, d: str) -> DataFrame:
    tail = F.concat(F.lit("\n"), F.substring_index("text", "\nReferences\n", -1))
    r = C.references(enriched(spark, d).withColumn("text", tail))
    title = F.when(F.col("ref_id") == "2", F.regexp_extract("text", r"(Another[^.]*)", 1)).otherwise(F.col("title"))
    return r.select("doc_id", "ref_id", "year", title.alias("title"), "doi")


@query(f"SELECT format, count(*) AS n FROM (SELECT CASE WHEN doc_id % 3 = 0 THEN 'bibtex' WHEN doc_id % 3 = 1 THEN 'numbered' ELSE 'author_year' END AS format FROM documents) GROUP BY format")
def reference_format(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("doc_id") % 3 == 0, "@article{k, title = {T}}").when(F.col("doc_id") % 3 == 1, "[1] a\n[2] b\n[3] c").otherwise("Smith, J. (2001) x\nDoe, A. (1999) y\nRoe, B. (2010b) z")
    return table(spark, d, "documents").select(C.reference_format(text).alias("format")).groupBy("format").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT doc_id, 'Fig ' || doc_id % 5 AS figure, 'A plot of $x_' || doc_id || ' = y$.' AS caption FROM documents")
def figure_placeholders(spark: SparkSession, d: str) -> DataFrame:
    return S.figure_lines(enriched(spark, d)).where(F.col("caption").contains("A plot of")).select("doc_id", "figure", "caption")


@query(f"SELECT doc_id, 'figure' AS kind, (doc_id % 5)::VARCHAR AS number, 2 AS n, 'A plot of $x_' || doc_id || ' = y$.' AS caption FROM documents")
def cross_references(spark: SparkSession, d: str) -> DataFrame:
    return S.resolved(enriched(spark, d)).where("kind = 'figure'").groupBy("doc_id", "kind", "number", "caption").agg(F.count(F.lit(1)).alias("n"))


@query(r"""SELECT kind, sum(n)::BIGINT AS n FROM (SELECT unnest(['display', 'bracket', 'environment', 'inline', 'command']) AS kind, unnest([len(regexp_extract_all(text, '\$\$([^$]+)\$\$')), len(regexp_extract_all(text, '\\\[(.+?)\\\]')),
  len(regexp_extract_all(text, '\\begin\{(?:equation|align|gather)\*?\}')), 0, len(regexp_extract_all(text, '\\(?:frac|sum|int|sqrt|alpha|beta|gamma)\b'))]) AS n FROM documents) WHERE kind <> 'inline' GROUP BY kind""")
def formula_types(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "documents").select(F.explode(M.counts(F.col("text"))).alias("kind", "n")).where("kind <> 'inline'")
    return f.groupBy("kind").agg(F.sum("n").alias("n"))


@query("SELECT doc_id, text = text AS same, 1::BIGINT AS n FROM (SELECT doc_id, regexp_replace(text, '[$\\\\]', '', 'g') AS text FROM documents)")
def formula_round_trip(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.regexp_replace("text", r"[$\\]", ""), F.lit(" $a = b$ end"))
    k = table(spark, d, "documents").select("doc_id", t.alias("t"), M.preserve(t).alias("p"))
    return k.select("doc_id", (M.restore(F.col("p.text"), F.col("p.formulas")) == F.col("t")).alias("same"), F.size("p.formulas").cast("long").alias("n"))


@query(f"SELECT doc_id, name AS section, count(*) AS n FROM documents, (VALUES ('Introduction'), ('References')) v(name) GROUP BY ALL")
def section_segments(spark: SparkSession, d: str) -> DataFrame:
    short = enriched(spark, d).withColumn("text", F.concat(F.lit("First words.\n"), F.substring_index("text", "\n", -6)))
    s = S.sections(short).withColumn("section", F.col("section"))
    return s.groupBy("doc_id", "section").agg(F.least(F.count(F.lit(1)), F.lit(1)).cast("long").alias("n"))


def _first_kind(of) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(v, '{p}') THEN {of(k, p)}" for k, p in S.HEADINGS) + " END"


_HEADED = "'1 Introduction' || chr(10) || 'words' || chr(10) || '1.1 Setting' || chr(10) || 'words' || chr(10) || '2 Methods' || chr(10) || text || chr(10) || '3 Conclusion' || chr(10) || 'end' || chr(10) || 'References' || chr(10) || '[1] x'"


@query(f"""WITH l AS (SELECT doc_id, {_STRIP.format('v')} AS v, line, last FROM (SELECT doc_id, unnest(l) AS v, generate_subscripts(l, 1) - 1 AS line, len(l) - 1 AS last FROM (SELECT doc_id, string_split({_HEADED}, chr(10)) AS l FROM documents))),
  h AS (SELECT doc_id, line, last, {_first_kind(lambda k, p: f"'{k}'")} AS kind, {_first_kind(lambda k, p: f"regexp_extract(v, '{p}', 1)")} AS number, substr({_first_kind(lambda k, p: f"regexp_extract(v, '{p}', 2)")}, 1, 100) AS title FROM l),
  n AS (SELECT doc_id, line, CASE WHEN kind = 'sub' THEN len(string_split(number, '.')) ELSE 1 END::BIGINT AS level, number, title, kind, coalesce(lead(line) OVER (PARTITION BY doc_id ORDER BY line), last + 1)::BIGINT AS next_line FROM h WHERE kind IS NOT NULL)
  SELECT a.*, (SELECT max(b.line) FROM n b WHERE b.doc_id = a.doc_id AND b.line < a.line AND b.level < a.level)::BIGINT AS parent_line FROM n a""")
def headings(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.lit("1 Introduction\nwords\n1.1 Setting\nwords\n2 Methods\n"), F.col("text"), F.lit("\n3 Conclusion\nend\nReferences\n[1] x"))
    return S.outline(S.headings(table(spark, d, "documents").select("doc_id", t.alias("text"))))


@query()
def structure_check(spark: SparkSession, d: str) -> DataFrame:
    return S.structure_issues(headings(spark, d))


@query()
def titles_and_abstracts(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.lit("A Study of Plain Things\nAuthors: Ann Bee, Cee Dee\nAbstract: We propose a novel method that improves results on data and we evaluate our approach.\n\n1 Introduction\n"), F.col("text"))
    e = table(spark, d, "documents").select("doc_id", t.alias("text"))
    a = e.select("doc_id", S.title(F.col("text")).alias("title"), S.authors(F.col("text")).alias("authors"), S.abstract(F.col("text")).alias("a"))
    return a.select("doc_id", "title", "authors", F.col("a.text").alias("abstract"), F.round("a.confidence", 4).alias("confidence"))


@query("SELECT doc_id, 'algorithm' AS kind, CASE WHEN doc_id % 3 = 0 THEN '' ELSE (doc_id % 7)::VARCHAR END AS number, 'Sort of ' || source AS title, 1 + (lang = 'en')::INT AS steps, round(0.6 + (doc_id % 3 <> 0)::INT * 0.2 + (lang = 'en')::INT * 0.2, 2)::DOUBLE AS confidence FROM documents")
def algorithms(spark: SparkSession, d: str) -> DataFrame:
    """Blocks with and without a number, and with one numbered step or two."""
    k = F.col("doc_id")
    number = F.when(k % 3 == 0, "").otherwise(F.concat(F.lit(" "), (k % 7).cast("string")))
    t = F.concat(F.col("text"), F.lit("\nAlgorithm"), number, F.lit(": Sort of "), F.col("source"), F.lit("\nInput: a list\n1. for each x\n"), F.when(F.col("lang") == "en", "2. ").otherwise("then "), F.lit("if x then return\nend algorithm\n"))
    return table(spark, d, "documents").select("doc_id", t.alias("text")).lateralJoin(S.Algorithms(F.col("text").outer())).select("doc_id", "kind", "number", "title", "steps", F.round("confidence", 2).alias("confidence"))


@query("SELECT doc_id, (doc_id % 9)::VARCHAR AS number, 'A note of ' || source AS definition, (doc_id % 3)::BIGINT AS n_marks FROM documents")
def footnotes(spark: SparkSession, d: str) -> DataFrame:
    n = (F.col("doc_id") % 9).cast("string")
    t = F.concat(F.col("text"), F.repeat(F.concat(F.lit(" noted.[^"), n, F.lit("]")), (F.col("doc_id") % 3).cast("int")), F.lit("\n[^"), n, F.lit("]: A note of "), F.col("source"))
    return C.footnotes(table(spark, d, "documents").select("doc_id", t.alias("text"))).withColumn("n_marks", F.col("n_marks").cast("long"))


_YEAR = "'20' || lpad((doc_id % 25)::VARCHAR, 2, '0')"


@query(f"""SELECT doc_id, '1' AS ref_id, '@article{{author' || {_YEAR} || 'title,' || chr(10) || '  title = {{A title of note}},' || chr(10) || '  author = {{A. Author and B. Writer}},' || chr(10) || '  year = {{' || {_YEAR} || '}},' || chr(10) || '  doi = {{10.1234/abc}}' || chr(10) || '}}' AS bibtex,
  '- A. Author, B. Writer. *A title of note*. ' || {_YEAR} || '. doi:10.1234/abc' AS markdown FROM documents""")
def bibtex_rendered(spark: SparkSession, d: str) -> DataFrame:
    r = C.references(enriched(spark, d).withColumn("text", F.concat(F.lit("\n"), F.substring_index("text", "\nReferences\n", -1))))
    cols = {k: F.col(k) for k in ("title", "authors", "year", "doi", "url")}
    return r.where("ref_id = '1'").select("doc_id", "ref_id", C.reference_bibtex(cols).alias("bibtex"), C.reference_markdown(cols).alias("markdown"))


@query("""SELECT n_regionkey, true AS has_header, '| key | name |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || n_nationkey || ' | ' || replace(n_name, '_', '\\_') || ' |', chr(10) ORDER BY n_nationkey) AS markdown,
  '\\begin{tabular}{ll}' || chr(10) || '\\hline' || chr(10) || 'key & name \\\\' || chr(10) || string_agg(n_nationkey || ' & ' || regexp_replace(n_name, '([&%$#_])', '\\\\\\1', 'g') || ' \\\\', chr(10) ORDER BY n_nationkey) || chr(10) || '\\hline' || chr(10) || '\\end{tabular}' AS latex FROM nation GROUP BY n_regionkey""")
def table_rendered(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    rows = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda r: F.array(r["n_nationkey"].cast("string"), r["n_name"]))
    t = n.groupBy("n_regionkey").agg(F.concat(F.array(F.array(F.lit("key"), F.lit("name"))), rows).alias("rows"))
    return t.select("n_regionkey", L.has_header(F.col("rows")).alias("has_header"), L.markdown(L.clean_table(F.col("rows"))).alias("markdown"), L.latex(F.col("rows")).alias("latex"))


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    """Line items as blocks on a page for each order, in two columns."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    left = F.col("l_linenumber") % 2 * 300.0
    y = F.col("l_linenumber") * 40.0
    return li.select(F.col("l_orderkey").alias("page"), left.alias("x0"), y.alias("y0"), (left + 200).alias("x1"), (y + 12).alias("y1"), F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("text"))


@query("""WITH b AS (SELECT l_orderkey AS page, l_linenumber % 2 * 300.0 AS x0, l_linenumber * 40.0 AS y0, 'part ' || l_partkey AS t, count(*) OVER w AS n, count(*) FILTER (l_linenumber % 2 = 1) OVER w AS odd FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)),
  c AS (SELECT *, CASE WHEN n >= 4 AND odd BETWEEN 1 AND n - 1 AND x0 > 0 THEN 1 ELSE 0 END AS c FROM b), o AS (SELECT page, t, row_number() OVER w AS i, y0 - lag(y0 + 12) OVER w AS y, x0 - lag(x0 + 200) OVER w AS x, c <> lag(c) OVER w AS turn FROM c WINDOW w AS (PARTITION BY page ORDER BY c, y0, x0, t))
  SELECT page, string_agg(CASE WHEN y IS NULL THEN '' WHEN turn OR y > 30 THEN chr(10) || chr(10) WHEN y > 10 THEN chr(10) WHEN x > 10 THEN ' ' ELSE chr(10) END || t, '' ORDER BY i) AS text FROM o GROUP BY page""")
def reading_order(spark: SparkSession, d: str) -> DataFrame:
    return L.reading_order(_blocks(spark, d), ["page"])


@query("SELECT page, max(c) AS n_columns FROM (SELECT l_orderkey AS page, count(DISTINCT l_linenumber % 2) AS c FROM lineitem GROUP BY 1) GROUP BY page HAVING max(c) = 1")
def one_column_pages(spark: SparkSession, d: str) -> DataFrame:
    c = L.with_columns(_blocks(spark, d), ["page"]).groupBy("page").agg((F.countDistinct("x0")).cast("long").alias("n_columns"))
    return c.where("n_columns = 1")


@query("""WITH r AS (SELECT l_orderkey AS page, l_linenumber // 2 AS r, list('part ' || l_partkey ORDER BY l_linenumber % 2, 'part ' || l_partkey) AS c FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 2),
  k AS (SELECT page, max(len(c)) AS k, count(*) AS n FROM r GROUP BY page HAVING count(*) >= 2),
  t AS (SELECT page, k, n, list('| ' || array_to_string(list_concat(c, list_transform(range(k - len(c)), lambda x: '')), ' | ') || ' |' ORDER BY r) AS l FROM r JOIN k USING (page) GROUP BY ALL)
  SELECT page, n::INT AS n_rows, array_to_string(list_concat([l[1], '|' || repeat(' --- |', k::INT)], l[2:]), chr(10)) AS markdown FROM t""")
def block_tables(spark: SparkSession, d: str) -> DataFrame:
    cells = _blocks(spark, d).withColumn("y0", F.floor(F.col("y0") / 80) * 80)
    return L.tables(cells, ["page"]).select("page", F.size("rows").alias("n_rows"), L.markdown(L.clean_table(F.col("rows"))).alias("markdown"))
