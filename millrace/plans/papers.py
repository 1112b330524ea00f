"""Papers as a whole, over conversations as papers of pages and over enriched documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quality as Q
from ..functions import text as T
from ..operators import papers as P
from ..operators import relational as R
from ..operators import structure as S
from .extraction import _CITES, _E, _MARKS, enriched
from .registry import query, table
from .texts import _STRIP

SIZE, STEP = 450, 400


def _papers(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(papers, pages, sections, chunks): a paper's text is its turns, two characters apart."""
    c = table(spark, d, "conversations")
    pages = R.offsets(c.select("conv_id", "turn", "text"), "conv_id", "turn", F.length("text")).select("conv_id", F.col("turn").alias("page"), "start", "end", "text")
    papers = pages.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda p: p["text"]), "\n\n").alias("text"))
    n = F.length("text")
    two = F.array(F.struct(F.lit(10).alias("start"), F.floor(n / 3).alias("end"), F.lit("Methods").alias("section")), F.struct(F.floor(n / 3).alias("start"), (n - 20).cast("long").alias("end"), F.lit("Results").alias("section")))
    sections = papers.where(n > 60).select("conv_id", F.inline(two)).select("conv_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "section")
    at = F.explode(F.sequence(F.lit(0), F.floor((n - 1) / STEP).cast("int")))
    chunks = papers.where(n > 0).select("conv_id", "text", at.alias("chunk_index")).withColumn("char_start", F.col("chunk_index") * STEP)
    chunks = chunks.withColumn("char_end", F.least(F.col("char_start") + SIZE, n)).withColumn("text", F.substring(F.col("text"), F.col("char_start") + 1, F.lit(SIZE)))
    return papers, pages, sections, chunks


_PAPERS = f"""WITH g AS (SELECT conv_id, turn AS page, text, coalesce(sum(length(text) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s FROM conversations),
  p AS (SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY page) AS text, count(*) AS n_pages, max(page) AS last FROM g GROUP BY conv_id),
  k AS (SELECT *, length(text) AS n FROM p), c AS (SELECT conv_id, i AS chunk_index, i * {STEP} AS char_start, least(i * {STEP} + {SIZE}, n) AS char_end, n, last FROM (SELECT *, unnest(generate_series(0, (n - 1) // {STEP})) AS i FROM k WHERE n > 0))"""


def _section(at: str) -> str:
    return f"CASE WHEN n <= 60 THEN 'Unknown' WHEN {at} >= 10 AND {at} < n // 3 THEN 'Methods' WHEN {at} >= n // 3 THEN 'Results' ELSE 'Unknown' END"


def _page(at: str) -> str:
    return f"coalesce((SELECT min(page) FROM g WHERE g.conv_id = c.conv_id AND s <= {at} AND {at} < s + length(text)), last)"


@query(f"{_PAPERS} SELECT conv_id, conv_id || '_chunk_' || chunk_index AS chunk_id, {_section('char_start')} AS section, {_page('char_start')} AS page, {_section('char_end')} AS section_end, {_page('char_end')} AS page_end FROM c")
def annotated_chunks(spark: SparkSession, d: str) -> DataFrame:
    _, pages, sections, chunks = _papers(spark, d)
    return P.annotated(chunks.drop("text"), sections, pages, "conv_id").select("conv_id", "chunk_id", "section", "page", "section_end", "page_end")


@query(f"{_PAPERS} SELECT k.conv_id, coalesce(m, 0)::BIGINT AS num_chunks, n_pages AS num_pages, CASE WHEN n > 60 THEN 2 ELSE 0 END::BIGINT AS num_sections, n::BIGINT AS total_chars, round(coalesce(z, 0), 6)::DOUBLE AS avg_chunk_size FROM k LEFT JOIN (SELECT conv_id, count(*) AS m, avg(char_end - char_start) AS z FROM c GROUP BY 1) USING (conv_id)")
def document_statistics(spark: SparkSession, d: str) -> DataFrame:
    papers, pages, sections, chunks = _papers(spark, d)
    out = P.statistics(papers, chunks, sections, pages, "window", "conv_id").drop("chunking_method")
    return out.withColumn("avg_chunk_size", F.round("avg_chunk_size", 6))


@query("SELECT count(*) AS total, count(*) FILTER (s = 'successful') AS successful, count(*) FILTER (s = 'failed') AS failed, count(*) FILTER (s = 'skipped') AS skipped, count(*) FILTER (s = 'failed') AS errors FROM (SELECT CASE WHEN length(text) < 50 THEN 'failed' WHEN starts_with(lang, 'f') THEN 'skipped' ELSE 'successful' END AS s FROM documents)")
def batch_totals(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.length("text") < 50, "failed").when(F.startswith("lang", F.lit("f")), "skipped").otherwise("successful")
    return P.batch_totals(table(spark, d, "documents").select(status.alias("status"), F.when(F.length("text") < 50, "too short").alias("error")))


_LOCATED = rf"""SELECT doc_id, place - 1 AS place, mark, pos AS position, 'Introduction' AS section, 1 AS page FROM (SELECT doc_id, ref, unnest(m) AS mark, generate_subscripts(m, 1) AS place,
  unnest(list_transform(m, lambda x, i: (list_sum(list_transform(z[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0))::BIGINT)) AS pos
  FROM (SELECT doc_id, {_MARKS} AS m, string_split_regex(text, '\[[0-9]+(?:[, \t\n\r\f\-][0-9]+)*\]|\([0-9]+(?:[, \t\n\r\f\-][0-9]+)*\)') AS z, instr(text, chr(10) || 'References' || chr(10)) AS ref FROM {_E})) WHERE pos < ref AND {_CITES}"""


@query(_LOCATED)
def located_citations(spark: SparkSession, d: str) -> DataFrame:
    """Citations outside the list of references, with the section they stand in."""
    docs = enriched(spark, d)
    sections = S.sections(docs).select("doc_id", F.col("start_char").alias("start"), F.col("end_char").alias("end"), "section")
    none = sections.select("doc_id", "start", "end", F.lit(1).alias("page")).limit(0)
    return P.located_citations(docs, sections, none).select("doc_id", "place", "mark", "position", "section", "page")


_MORE = f"(SELECT doc_id, text || chr(10) || 'See Table ' || doc_id % 3 || ', Table 2 and Section 4.' || chr(10) || 'Table 2: Numbers' AS text FROM {_E})"


@query(rf"""WITH t AS (SELECT doc_id, text, length(text) AS n FROM {_MORE}), m AS (SELECT doc_id, 'figure' AS kind, unnest(regexp_extract_all(text, '\b(?:Figure|Fig\.?) *([0-9]+)', 1)) AS number FROM t
  UNION ALL SELECT doc_id, 'table', unnest(regexp_extract_all(text, '\b(?:Table|Tab\.) *([0-9]+)', 1)) FROM t UNION ALL SELECT doc_id, 'section', unnest(regexp_extract_all(text, '\bSection *([0-9]+)', 1)) FROM t),
  h AS (SELECT m.*, CASE kind WHEN 'figure' THEN true WHEN 'table' THEN number = '2' ELSE false END AS ok FROM m)
  SELECT doc_id, kind, count(*) AS total, count(*) FILTER (ok) AS resolved, count(*) FILTER (NOT ok) AS unresolved, round(any_value(k) / (any_value(n) / 1000), 2)::DOUBLE AS density FROM h JOIN t USING (doc_id) JOIN (SELECT doc_id, count(*) AS k FROM m GROUP BY 1) USING (doc_id) GROUP BY doc_id, kind""")
def reference_summary(spark: SparkSession, d: str) -> DataFrame:
    more = F.concat(F.col("text"), F.lit("\nSee Table "), (F.col("doc_id") % 3).cast("string"), F.lit(", Table 2 and Section 4.\nTable 2: Numbers"))
    docs = enriched(spark, d).withColumn("text", more)
    return P.reference_summary(S.resolved(docs), docs)


@query(f"SELECT doc_id FROM (SELECT DISTINCT doc_id, mark FROM (SELECT doc_id, unnest({_MARKS}) AS mark FROM {_E}) WHERE {_CITES}) GROUP BY doc_id HAVING count(*) >= 5")
def cited_enough(spark: SparkSession, d: str) -> DataFrame:
    return P.cited_enough(enriched(spark, d), 5).select("doc_id")


@query(f"""WITH x AS (SELECT doc_id, text, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'A. One and B. Two' ELSE 'On ' || source END AS t, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'Eds. of ' || lang ELSE 'Workshop ' || lang END AS a FROM documents),
  y AS (SELECT *, t <> '' AND a <> '' AND (contains(lower(t), 'and') OR contains(lower(t), 'eds.')) AND NOT (contains(lower(a), 'and') OR contains(lower(a), 'eds.')) AS w, list_filter(list_transform(string_split(text, chr(10)), lambda v: {_STRIP.format('v')}), lambda v: v <> '') AS l FROM x)
  SELECT doc_id, CASE WHEN w THEN a WHEN t <> '' THEN t ELSE coalesce(l[1], '') END AS title, CASE WHEN w THEN t WHEN a <> '' THEN a ELSE coalesce(l[2], '') END AS author FROM y""")
def title_and_author(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    t = F.when(k % 4 == 0, "").when(k % 4 == 1, "A. One and B. Two").otherwise(F.concat(F.lit("On "), F.col("source")))
    a = F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit("Eds. of "), F.col("lang"))).otherwise(F.concat(F.lit("Workshop "), F.col("lang")))
    return table(spark, d, "documents").select("doc_id", P.title_and_author(t, a, F.col("text")).alias("m")).select("doc_id", "m.*")


@query("""SELECT doc_id, length(array_to_string(list_filter(l, lambda x, i: NOT (regexp_matches(x, '^[ \\t\\r\\f]*[0-9]+[ \\t\\r\\f]*$') OR (regexp_matches(x, '^(?i:proceedings|conference|workshop|©)') AND i < len(l)))), chr(10)))::BIGINT AS n
  FROM (SELECT doc_id, string_split('Proceedings of it' || chr(10) || ' 12 ' || chr(10) || text || chr(10) || 'WORKSHOP ' || doc_id || chr(10) || doc_id || chr(10) || 'Conference on it', chr(10)) AS l FROM documents)""")
def extra_headers(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id").cast("string")
    t = F.concat(F.lit("Proceedings of it\n 12 \n"), F.col("text"), F.lit("\nWORKSHOP "), k, F.lit("\n"), k, F.lit("\nConference on it"))
    return table(spark, d, "documents").select("doc_id", F.length(T.remove_extra_headers(t)).cast("long").alias("n"))


@query("SELECT event_id, CASE WHEN s < 60 THEN round(s)::BIGINT || 's' WHEN s < 3600 THEN round(s / 60)::BIGINT || 'm ' || s % 60 || 's' ELSE round(s / 3600)::BIGINT || 'h ' || round((s % 3600) / 60)::BIGINT || 'm' END AS took FROM (SELECT event_id, event_id * 7 + 1 AS s FROM events) WHERE (s % 60) <> 30 AND (s % 3600) <> 1800")
def durations(spark: SparkSession, d: str) -> DataFrame:
    """Seconds written out, but for halves, which engines round differently."""
    s = F.col("event_id") * 7 + 1
    return table(spark, d, "events").where((s % 60 != 30) & (s % 3600 != 1800)).select("event_id", T.duration(s).alias("took"))


@query(f"""{_PAPERS}, q AS (SELECT conv_id, avg(length(text)) AS mean, count(*) FILTER (length(text) < 50) AS empty, count(*) AS m FROM g GROUP BY 1) SELECT k.conv_id, s >= 0.95 AS score_passed, CASE WHEN n > 10000 THEN 'good' WHEN n > 5000 THEN 'adequate' ELSE 'low' END AS length_status,
  round(mean)::DOUBLE AS avg_chars_per_page, empty AS empty_pages, mean >= 1000 AND empty / m <= 0.05 AS coverage_passed, (s < 0.95)::INT + (mean < 1000)::INT AS n_advice FROM (SELECT *, 0.9 + least(n, 5000) / 50000.0 AS s FROM k) k JOIN q USING (conv_id)""")
def extraction_report(spark: SparkSession, d: str) -> DataFrame:
    papers, pages, _, _ = _papers(spark, d)
    counts = pages.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("page", F.length("text").alias("char_count")))).alias("pages"))
    score = 0.9 + F.least(F.length("text"), F.lit(5000)) / 50000.0
    r = papers.join(counts, "conv_id").select("conv_id", Q.quality_report(score, F.col("text"), F.col("pages")).alias("r"))
    return r.select("conv_id", "r.score_passed", "r.length_status", "r.avg_chars_per_page", "r.empty_pages", "r.coverage_passed", F.size("r.recommendations").alias("n_advice"))


@query(f"""SELECT doc_id, min(ref_id) AS ref_id, body FROM (SELECT doc_id, ref_id, {_STRIP.format('body')} AS body FROM (SELECT doc_id, '1' AS ref_id, 'A. Author. A title of note. 2001.' AS body FROM documents UNION ALL SELECT doc_id, '7', 'B. Writer. Of ' || source FROM documents UNION ALL SELECT doc_id, NULL, 'Smith, J. On ' || lang || ' (1999). A venue.' FROM documents)) GROUP BY doc_id, body""")
def references_of_any_format(spark: SparkSession, d: str) -> DataFrame:
    """References in three notations, one of them in two of these at once."""
    text = F.concat(F.lit("Smith, J. On "), F.col("lang"), F.lit(" (1999). A venue.\n7. B. Writer. Of "), F.col("source"), F.lit("\n[1] A. Author. A title of note. 2001."))
    return P.references_of_any_format(table(spark, d, "documents").select("doc_id", text.alias("text"))).select("doc_id", "ref_id", F.col("text").alias("body"))


@query("SELECT doc_id, 'Second Part' AS title, 'Words of ' || source || chr(10) || 'and ' || lang AS text FROM documents")
def section_by_number(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("1 First Part\nsome\n2 Second Part\nWords of "), F.col("source"), F.lit("\nand "), F.col("lang"), F.lit("\n3 Third Part\nmore"))
    return P.section_text(table(spark, d, "documents").select("doc_id", text.alias("text")), "2")


@query("SELECT c_nationkey AS doc_id, t AS title, min(c_custkey) AS start_line FROM (SELECT *, upper(c_mktsegment) AS t FROM customer) GROUP BY 1, 2")
def first_by_title(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("doc_id"), F.when(F.col("c_custkey") % 2 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("title"), F.col("c_custkey").alias("start_line"))
    return P.first_by_title(c).withColumn("title", F.upper("title"))


@query("SELECT conv_id, turn, length(text)::BIGINT AS n FROM conversations")
def header_lines_removed(spark: SparkSession, d: str) -> DataFrame:
    """Pages with a running head and foot lose them and nothing else."""
    c = table(spark, d, "conversations")
    paged = c.withColumn("text", F.concat(F.lit("Running head\n"), F.col("text"), F.lit("\nfoot of "), F.col("conv_id").cast("string")))
    many = c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("conv_id")
    voted = S.voted_lines(paged, "conv_id", "turn", edge=1)
    cut = P.without_voted_lines(paged.join(many, "conv_id"), voted, "conv_id", edge=1)
    whole = c.join(many, "conv_id", "left_anti")
    return cut.select("conv_id", "turn", F.length("text").cast("long").alias("n")).union(whole.select("conv_id", "turn", F.length("text").cast("long")))
