"""Corpus reports over documents and their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quality as Q
from ..functions import text as T
from ..operators import relational as R
from ..operators import reports
from .registry import query, table

_STATS = "count(x) AS n, round(avg(x), 4) AS mean, round(median(x), 4) AS median, round(stddev_samp(x), 4) AS stdev, min(x)::DOUBLE AS min, max(x)::DOUBLE AS max"
_BAND = "CASE WHEN n < 50 THEN '<50' WHEN n < 200 THEN '50-199' WHEN n <= 1500 THEN '200-1500' WHEN n <= 2000 THEN '1501-2000' ELSE '>2000' END"
_WORDS = r"len(list_filter(regexp_split_to_array(text, '[ \t\n\r\f]+'), lambda w: w <> ''))"


@query(f"SELECT band, n, round(100.0 * n / sum(n) OVER (), 4) AS pct FROM (SELECT {_BAND} AS band, count(*) AS n FROM (SELECT length(text) AS n FROM documents) GROUP BY 1)")
def corpus_size_bands(spark: SparkSession, d: str) -> DataFrame:
    return reports.size_bands(table(spark, d, "documents"), F.length("text"))


@query(f"SELECT {_STATS} FROM (SELECT length(text)::DOUBLE AS x FROM documents)")
def corpus_size_stats(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").agg(*reports.stats(F.length("text")))


@query(f"SELECT lang, {_STATS} FROM (SELECT lang, length(text)::DOUBLE AS x FROM documents) GROUP BY lang")
def size_stats_by_lang(spark: SparkSession, d: str) -> DataFrame:
    return reports.by_group(table(spark, d, "documents"), "lang", F.length("text"))


@query(f"SELECT source, {_STATS} FROM (SELECT source, length(text)::DOUBLE AS x FROM documents) GROUP BY source")
def size_stats_by_source(spark: SparkSession, d: str) -> DataFrame:
    return reports.by_group(table(spark, d, "documents"), "source", F.length("text"))


@query(rf"""SELECT count(*) AS total, count(*) FILTER (length(text) < 50) AS too_short, count(*) FILTER (length(text) > 2000) AS too_long,
  count(*) FILTER (length(text) BETWEEN 200 AND 1500) AS optimal, count(*) FILTER (greatest(1, floor({_WORDS} / 0.75)) > 8192) AS over_token_limit,
  count(*) FILTER (regexp_replace(text, '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g') = '') AS empty, count(*) FILTER (regexp_matches(text, '^[^A-Za-z0-9\x{{80}}-\x{{10FFFF}}]+$')) AS special_only,
  count(*) FILTER (contains(text, chr(65533))) AS bad_encoding, count(*) FILTER (regexp_matches(text, '<[^>]+>')) AS with_html, count(*) FILTER (regexp_matches(text, '^[$\\]+')) AS latex_start,
  count(*) FILTER ((length(text) - length(replace(text, chr(10), ''))) * 10 > length(text)) AS newline_dense, count(*) FILTER (contains(text, repeat(' ', 20))) AS space_run,
  count(*) FILTER (regexp_matches(text, '^https?://')) AS url_start, count(*) FILTER (NOT (starts_with(text, '#') OR contains(substr(text, 1, 100), '##'))) AS no_header FROM documents""")
def embedding_readiness(spark: SparkSession, d: str) -> DataFrame:
    return reports.embedding_readiness(table(spark, d, "documents"))


_TYPED = """SELECT text FROM documents UNION ALL SELECT * FROM (VALUES ('https://a.b/c'), ('[12] cited'), ('Table 3 shows'), ('Figure 4 shows'), ('$x = y$'), ('def f(): pass'))"""


@query(rf"""SELECT type, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(text, '^https?://') THEN 'url' WHEN regexp_matches(text, '^\[[0-9]+\]') THEN 'citation'
  WHEN regexp_matches(text, '^Table +[0-9]+') THEN 'table' WHEN regexp_matches(text, '^Figure +[0-9]+') THEN 'figure' WHEN regexp_matches(text, '^\$.*\$') THEN 'equation'
  WHEN regexp_matches(text, '^(?:```|def |class )') THEN 'code' ELSE 'text' END AS type FROM ({_TYPED})) GROUP BY type""")
def content_type_chain(spark: SparkSession, d: str) -> DataFrame:
    own = spark.createDataFrame([(x,) for x in ("https://a.b/c", "[12] cited", "Table 3 shows", "Figure 4 shows", "$x = y$", "def f(): pass")], "text string")
    rows = table(spark, d, "documents").select("text").union(own)
    return rows.groupBy(T.content_type(F.col("text")).alias("type")).agg(F.count(F.lit(1)).alias("n"))


@query(r"""SELECT page_id, html AND TRUE AS has_html, dense AS newline_dense, NOT header AS no_header, html OR dense OR NOT header AS needs_cleaning FROM (
  SELECT page_id, regexp_matches(html, '<[^>]+>') AS html, (length(html) - length(replace(html, chr(10), ''))) * 10 > length(html) AS dense,
  starts_with(html, '#') OR contains(substr(html, 1, 100), '##') AS header FROM pages)""")
def needs_cleaning_flags(spark: SparkSession, d: str) -> DataFrame:
    h = F.col("html")
    out = table(spark, d, "pages").select("page_id", h.rlike("<[^>]+>").alias("has_html"), T.newline_dense(h).alias("newline_dense"), (~T.has_header(h)).alias("no_header"))
    return out.withColumn("needs_cleaning", F.col("has_html") | F.col("newline_dense") | F.col("no_header"))


@query("""SELECT n_issues, total, CASE WHEN n_issues = 0 THEN 'ready' WHEN n_issues * 100 < total THEN 'nearly_ready' WHEN n_issues * 20 < total THEN 'needs_minor_fixes' ELSE 'needs_work' END AS verdict
  FROM (SELECT count(*) FILTER (length(text) < 50 OR length(text) > 2000) AS n_issues, count(*) AS total FROM documents)""")
def readiness_verdict(spark: SparkSession, d: str) -> DataFrame:
    n = F.length("text")
    out = table(spark, d, "documents").agg(F.count_if((n < 50) | (n > 2000)).alias("n_issues"), F.count(F.lit(1)).alias("total"))
    return out.withColumn("verdict", reports.verdict(F.col("n_issues"), F.col("total")))


@query("SELECT count(*) - count(DISTINCT md5(lower(trim(text)))) AS n_duplicates FROM documents")
def dup_text_count(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").agg((F.count(F.lit(1)) - F.count_distinct(F.md5(F.lower(F.trim("text"))))).alias("n_duplicates"))


@query("SELECT doc_id, doc_id <> min(doc_id) OVER (PARTITION BY md5(lower(trim(text)))) AS is_dup FROM documents")
def dup_text_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.md5(F.lower(F.trim("text"))).alias("h"))
    first = rows.groupBy("h").agg(F.min("doc_id").alias("first"))
    return rows.join(first, "h").select("doc_id", (F.col("doc_id") != F.col("first")).alias("is_dup"))


@query("SELECT source, count(DISTINCT substr(text, 1, 100)) AS distinct_100, count(*) AS n, count(DISTINCT substr(text, 1, 100)) < 0.8 * count(*) AS flag FROM documents GROUP BY source")
def prefix_distinct_ratio(spark: SparkSession, d: str) -> DataFrame:
    out = table(spark, d, "documents").groupBy("source").agg(F.count_distinct(F.substring("text", 1, 100)).alias("distinct_100"), F.count(F.lit(1)).alias("n"))
    return out.withColumn("flag", F.col("distinct_100") < 0.8 * F.col("n"))


@query("""SELECT count(*) AS n_groups, sum(n - 1)::BIGINT AS n_removed, sum((n - 1) * c)::BIGINT AS chars_freed FROM (SELECT md5(text) AS h, count(*) AS n, max(length(text)) AS c FROM documents GROUP BY 1 HAVING count(*) > 1)""")
def dedup_savings(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "documents").groupBy(F.md5("text").alias("h")).agg(F.count(F.lit(1)).alias("n"), F.max(F.length("text")).alias("c")).where("n > 1")
    return g.agg(F.count(F.lit(1)).alias("n_groups"), F.sum(F.col("n") - 1).alias("n_removed"), F.sum((F.col("n") - 1) * F.col("c")).cast("long").alias("chars_freed"))


@query("""SELECT field, n, round(100.0 * n / greatest(t, 1), 4) AS pct FROM (SELECT count(*) AS t, count(nullif(text, '')) AS text, count(nullif(lang, '')) AS lang, count(nullif(source, '')) AS source, count(quality) AS quality, count(toxic) AS toxic
  FROM documents LEFT JOIN labels USING (doc_id)) UNPIVOT (n FOR field IN (text, lang, source, quality, toxic))""")
def metadata_coverage(spark: SparkSession, d: str) -> DataFrame:
    return reports.coverage(table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left"), ["text", "lang", "source", "quality", "toxic"])


@query("SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY key")
def metadata_key_frequency(spark: SparkSession, d: str) -> DataFrame:
    return reports.key_frequency(table(spark, d, "events"), F.from_json("props", "map<string,string>"))


@query("SELECT 'k' AS key, count(*) FILTER (NOT coalesce(list_contains(json_keys(props), 'k'), false)) AS n_missing FROM events UNION ALL SELECT 'section', count(*) FILTER (NOT coalesce(list_contains(json_keys(props), 'section'), false)) FROM events")
def missing_required_keys(spark: SparkSession, d: str) -> DataFrame:
    return reports.missing_keys(table(spark, d, "events"), F.from_json("props", "map<string,string>"), ["k", "section"])


@query("SELECT doc_id, length(text)::BIGINT AS n FROM documents ORDER BY n, doc_id LIMIT 10")
def bottom10_small(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.length("text").cast("long").alias("n")).orderBy("n", "doc_id").limit(10)


@query("SELECT doc_id, length(text)::BIGINT AS n FROM documents ORDER BY n DESC, doc_id LIMIT 10")
def top10_large(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.length("text").cast("long").alias("n")).orderBy(F.desc("n"), "doc_id").limit(10)


@query("SELECT doc_id FROM documents ORDER BY md5('42-' || doc_id), doc_id LIMIT 100")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return R.sampled(table(spark, d, "documents").select("doc_id"), "doc_id", 100)


@query("""WITH c AS (SELECT conv_id, count(*) AS k, sum(length(text)) AS n, avg(length(text)) AS a, max(trim(text)) = '' AS blank FROM conversations GROUP BY conv_id),
  i AS (SELECT unnest(list_filter([CASE WHEN n < 500 THEN 'text too short' END, CASE WHEN k < 5 THEN 'too few chunks' END, CASE WHEN a < 100 THEN 'chunks too short' END, CASE WHEN n >= 500 AND n < 2000 THEN 'text quite short' END], lambda x: x IS NOT NULL)) AS issue FROM c)
  SELECT issue, count(*) AS n FROM i GROUP BY issue ORDER BY n DESC, issue LIMIT 10""")
def top_issues(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("k"), F.sum(F.length("text")).alias("n"), F.avg(F.length("text")).alias("a"))
    issues = F.array_compact(F.array(F.when(F.col("n") < 500, "text too short"), F.when(F.col("k") < 5, "too few chunks"), F.when(F.col("a") < 100, "chunks too short"), F.when((F.col("n") >= 500) & (F.col("n") < 2000), "text quite short")))
    return c.select(F.explode(issues).alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "issue").limit(10)


@query("""WITH c AS (SELECT conv_id, count(*) AS k, sum(length(text)) AS n, avg(length(text)) AS a FROM conversations GROUP BY conv_id), s AS (SELECT conv_id, round(greatest(0.0, 10.0
  - CASE WHEN n < 500 THEN 2.0 WHEN n < 2000 THEN 0.5 ELSE 0 END - CASE WHEN n = 0 THEN 3.0 ELSE 0 END - CASE WHEN k = 0 THEN 0.5 WHEN k < 3 THEN 0.3 ELSE 0 END
  - CASE WHEN k = 0 THEN 5.0 WHEN k < 5 THEN 2.0 ELSE 0 END - CASE WHEN k = 0 THEN 0 WHEN a < 100 THEN 1.0 WHEN a > 2000 THEN 0.3 ELSE 0 END), 2)::DOUBLE AS score FROM c)
  SELECT conv_id, score, CASE WHEN score >= 9 THEN 'excellent' WHEN score >= 7 THEN 'good' WHEN score >= 5 THEN 'fair' ELSE 'poor' END AS band, score >= 7 AS rag_ready FROM s""")
def json_quality_score(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("k"), F.sum(F.length("text")).alias("n"), F.avg(F.length("text")).alias("a"))
    s = c.select("conv_id", Q.document_score(F.col("n"), F.col("n") == 0, F.col("k"), F.col("k"), F.col("a")).alias("score"))
    return s.withColumn("band", Q.score_band(F.col("score"))).withColumn("rag_ready", F.col("score") >= 7)


@query("""WITH x AS (SELECT value AS s, length(props) AS c FROM events), m AS (SELECT avg(s) AS ms, avg(c) AS mc FROM x), f AS (SELECT count(*) FILTER (s > 2 * ms) AS slow, count(*) FILTER (c < 0.5 * mc) AS thin,
  count(*) FILTER (s < 0.9) AS low_quality, count(*) FILTER (s < 0.7) AS very_low_quality, count(*) FILTER (c = 0) AS "empty" FROM x, m) SELECT rule, n FROM f UNPIVOT (n FOR rule IN (slow, thin, low_quality, very_low_quality, "empty")) WHERE n > 0""")
def improvement_rules(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return reports.improvements(e, F.col("value"), F.length("props"), F.col("value"))


@query("SELECT count(*) AS n, round(avg(value), 4) AS mean_s, round(median(value), 4) AS median_s, round(60 / nullif(avg(value), 0), 4) AS per_minute FROM events WHERE value IS NOT NULL")
def throughput_stats(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    return table(spark, d, "events").where(v.isNotNull()).agg(F.count(v).alias("n"), F.round(F.avg(v), 4).alias("mean_s"), F.round(F.median(v), 4).alias("median_s"), F.round(60 / F.nullif(F.avg(v), F.lit(0.0)), 4).alias("per_minute"))


@query("""SELECT count(*) AS total, count(*) FILTER (trim(text) = '') AS empty, count(*) FILTER (trim(text) <> '' AND length(text) < 50) AS short, count(*) FILTER (length(text) > 2000) AS long, round(avg(length(text)), 4) AS avg_size,
  median(length(text))::DOUBLE AS median_size, min(length(text))::BIGINT AS min_size, max(length(text))::BIGINT AS max_size, round(avg(quality::DOUBLE), 3) AS avg_quality, min(quality)::DOUBLE AS min_quality, max(quality)::DOUBLE AS max_quality,
  count(*) FILTER (quality < 0.7) AS low_quality, count(nullif(source, '')) AS with_section, count(quality) AS with_quality, count(*) FILTER (starts_with(text, '#') OR contains(substr(text, 1, 100), '##')) AS with_header FROM documents LEFT JOIN labels USING (doc_id)""")
def chunk_report(spark: SparkSession, d: str) -> DataFrame:
    chunks = table(spark, d, "documents").withColumnRenamed("source", "section").join(table(spark, d, "labels"), "doc_id", "left")
    return reports.chunk_report(chunks)


@query("""SELECT quality_band, count(*) AS n FROM (SELECT CASE WHEN q >= 1 THEN '1.00' WHEN q >= 0.98 THEN '0.98-1.00' WHEN q >= 0.95 THEN '0.95-0.98' WHEN q >= 0.9 THEN '0.90-0.95' ELSE '<0.90' END AS quality_band FROM (SELECT (doc_id % 23) / 22.0 AS q FROM documents)) GROUP BY 1""")
def quality_histogram(spark: SparkSession, d: str) -> DataFrame:
    q = (F.col("doc_id") % 23) / 22.0
    band = F.when(q >= 1, "1.00").when(q >= 0.98, "0.98-1.00").when(q >= 0.95, "0.95-0.98").when(q >= 0.9, "0.90-0.95").otherwise("<0.90")
    return table(spark, d, "documents").groupBy(band.alias("quality_band")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lang, count(*) AS n, round(avg(coalesce(quality, 0)), 4) AS avg_quality, list_sort(list(DISTINCT source)) AS sources FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def stats_by_method(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return x.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.coalesce("quality", F.lit(0))), 4).alias("avg_quality"), F.sort_array(F.collect_set("source")).alias("sources"))


@query(r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]{4,}') AS ws, len(regexp_extract_all(text, '[\p{L}\p{M}\p{N}_]+')) AS total FROM documents), p AS (SELECT doc_id, total, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
  c AS (SELECT doc_id, word, count(*) AS n, min(pos) AS f, any_value(total) AS total FROM p GROUP BY doc_id, word) SELECT doc_id, rank, word, n FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) AS rank, word, n FROM c WHERE n < 0.05 * total) WHERE rank <= 10""")
def keyword_fallback(spark: SparkSession, d: str) -> DataFrame:
    return reports.keyword_fallback(table(spark, d, "documents"))
