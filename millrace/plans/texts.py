"""Text functions and scores over documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quality as Q
from ..functions import text as T
from .registry import query, table

_STRIP = r"regexp_replace({}, '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g')"
_WORDS = r"list_filter(regexp_split_to_array({}, '[ \t\n\r\f]+'), lambda w: w <> '')"
_SENT = rf"list_filter(list_transform(string_split(regexp_replace({{}}, '([.!?])[ \t\n\r\f]+', '\1␞', 'g'), '␞'), lambda x: {_STRIP.format('x')}), lambda x: x <> '')"


def _chain(expr: str, *steps: tuple[str, str]) -> str:
    for pattern, to in steps:
        expr = f"regexp_replace({expr}, '{pattern}', '{to}', 'g')"
    return expr


def _replaced(expr: str, table_: dict[str, str]) -> str:
    for k, v in table_.items():
        expr = f"replace({expr}, '{k.replace(chr(39), chr(39) * 2)}', '{v.replace(chr(39), chr(39) * 2)}')"
    return expr


def _digest(key: str, name: str, column):
    return [F.col(key), F.md5(column).alias("digest"), F.length(column).cast("long").alias("n")]


#: documents with the characters that the normalising functions are about
_RICH = "text || ' €5 ₿ £ ½ Ⅳ → “x” ﬁ n² H₂O  a\u00a0b\u2009c ' || chr(10) || chr(10) || chr(10) || chr(10) || doc_id"


def _rich(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.col("text"), F.lit(" €5 ₿ £ ½ Ⅳ → “x” ﬁ n² H₂O  a\u00a0b\u2009c \n\n\n\n"), F.col("doc_id").cast("string"))
    return table(spark, d, "documents").select("doc_id", t.alias("text"))


@query(f"SELECT page_id, md5(x) AS digest, length(x)::BIGINT AS n FROM (SELECT page_id, {_replaced("regexp_replace(html, '<[^>]+>', '', 'g')", T.ENTITIES)} AS x FROM pages)")
def html_strip(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select(*_digest("page_id", "html", T.strip_html(F.col("html"))))


@query(f"SELECT doc_id, md5(x) AS digest, length(x)::BIGINT AS n FROM (SELECT doc_id, {_chain('replace(text, chr(10), chr(13) || chr(10))', (chr(92) + 'n{3,}', chr(10) * 2), (r'\r\n|\r', chr(10)))} AS x FROM documents)")
def newline_normalise(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(*_digest("doc_id", "text", T.normalise_newlines(F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n")))))


@query("SELECT doc_id, h AS has_header, CASE WHEN h THEN length(text) ELSE length('# ' || source || chr(10) || chr(10) || '## ' || lang || chr(10) || chr(10) || text) END::BIGINT AS n FROM (SELECT *, starts_with(text, '#') OR contains(substr(text, 1, 100), '##') AS h FROM documents)")
def context_header(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", T.has_header(t).alias("has_header"), F.length(T.context_header(t, F.col("source"), F.col("lang"))).cast("long").alias("n"))


@query(f"SELECT doc_id, md5(x) AS digest, length(x)::BIGINT AS n FROM (SELECT doc_id, {_STRIP.format(_chain(f'translate({_RICH}, {chr(39)}{T.SPACES}{chr(39)}, repeat({chr(39)} {chr(39)}, {len(T.SPACES)}))', (r'[ \t]+', ' '), (chr(92) + 'n{3,}', chr(10) * 2)))} AS x FROM documents)")
def whitespace_normalise(spark: SparkSession, d: str) -> DataFrame:
    return _rich(spark, d).select(*_digest("doc_id", "text", T.normalise_whitespace(F.col("text"))))


@query(f"SELECT doc_id, md5(x) AS digest, length(x)::BIGINT AS n FROM (SELECT doc_id, {_replaced(_replaced(_replaced(_replaced(_RICH, T.FRACTIONS), {"€": "EUR", "£": "GBP", "¥": "JPY/CNY", "¢": "cent", "₹": "INR"}), T.ROMAN), T.ARROWS)} AS x FROM documents)")
def special_chars(spark: SparkSession, d: str) -> DataFrame:
    return _rich(spark, d).select(*_digest("doc_id", "text", T.special_characters(F.col("text"))))


@query(f"SELECT doc_id, md5(x) AS digest, length(x)::BIGINT AS n FROM (SELECT doc_id, {_chain(f'translate({_replaced(_replaced(_chain(_RICH, (chr(91) + r'\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '')), T.LIGATURES), T.PUNCTUATION)}, {chr(39)}{T.SUPERSCRIPT + T.SUBSCRIPT}{chr(39)}, {chr(39)}{T.DIGITS * 2}{chr(39)})', (' {2,}', ' '))} AS x FROM documents)")
def encoding_fix(spark: SparkSession, d: str) -> DataFrame:
    return _rich(spark, d).select(*_digest("doc_id", "text", T.fix_encoding(F.col("text"))))


@query(f"SELECT doc_id, md5(x) AS digest, length(x)::BIGINT AS n FROM (SELECT doc_id, {_chain('text', (r'[ \t]+', ' '), ('rn', 'm'), ('vv', 'w'), ('ii', 'n'), (r' +([.,;:!?])', r'\1'), (r'([.,;:!?])([A-Za-z])', r'\1 \2'), (r'([0-9]) ([0-9])', r'\1\2'), (r'([A-Za-z])-\n([a-z])', r'\1\2'))} AS x FROM documents)")
def ocr_postfix(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(*_digest("doc_id", "text", T.ocr_postfix(F.col("text"))))


@query(f"SELECT doc_id, md5(x) AS digest, length(x)::BIGINT AS n FROM (SELECT doc_id, {_chain('text', (r'([a-z])([A-Z])', r'\1 \2'), (r'([0-9]) +([0-9])', r'\1\2'), (r' +([.,;:!?])', r'\1'), (r'([.,;:!?])([A-Za-z])', r'\1 \2'))} AS x FROM documents)")
def reader_fixes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(*_digest("doc_id", "text", T.reader_fixes(F.col("text"))))


@query(f"SELECT doc_id, md5(x) AS digest, length(x)::BIGINT AS n FROM (SELECT doc_id, {_chain('text', (r'([A-Za-z])-\n([a-z])', r'\1\2'), (r'([a-z,])\n([a-z])', r'\1 \2'))} AS x FROM documents)")
def line_break_repair(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(*_digest("doc_id", "text", T.line_breaks(F.col("text"))))


@query(f"SELECT doc_id, greatest(1, floor(len({_WORDS.format('text')}) / 0.75))::BIGINT AS tokens FROM documents")
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.token_estimate(F.col("text")).alias("tokens"))


@query(rf"""SELECT doc_id, round(CASE WHEN w = 0 OR s = 0 THEN 0 ELSE 206.835 - 1.015 * (w / s) - 84.6 * (v / w) END, 4)::DOUBLE AS flesch FROM (SELECT doc_id, len(regexp_extract_all(text, '[\p{{L}}\p{{M}}\p{{N}}_]+'))::DOUBLE AS w,
  len(list_filter(regexp_split_to_array(text, '[.!?]+'), lambda x: {_STRIP.format('x')} <> ''))::DOUBLE AS s, len(regexp_extract_all(text, '[aeiouyAEIOUY]+'))::DOUBLE AS v FROM documents)""")
def flesch(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.round(T.flesch(F.col("text")), 4).alias("flesch"))


@query(f"SELECT doc_id, md5(array_to_string(({_SENT.format('text')})[1:2], ' ')) AS digest FROM documents")
def summary_two_sentences(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(T.summary(F.col("text"))).alias("digest"))


_KEYED = "text || chr(10) || 'Keywords: attention, Transformer; ' || lang || ', w' || doc_id % 7"


def _keyed(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.col("text"), F.lit("\nKeywords: attention, Transformer; "), F.col("lang"), F.lit(", w"), (F.col("doc_id") % 7).cast("string"))
    return table(spark, d, "documents").select("doc_id", t.alias("text"))


@query(f"SELECT doc_id, list_filter(list_transform(regexp_split_to_array(regexp_extract({_KEYED}, '(?i)keywords?[ \\t]*[:：][ \\t]*([^\\n]+)', 1), '[;,] *'), lambda x: trim(x)), lambda x: x <> '') AS keywords FROM documents")
def keyword_line(spark: SparkSession, d: str) -> DataFrame:
    return _keyed(spark, d).select("doc_id", T.keyword_line(F.col("text")).alias("keywords"))


_TOPICS = ("Transformer", "graph neural network", "nothing", "Reinforcement Learning")


@query("SELECT doc_id, list_sort(list_distinct(list_filter([CASE doc_id % 4 WHEN 0 THEN 'deep_learning' WHEN 1 THEN 'graph_learning' WHEN 3 THEN 'reinforcement_learning' END, CASE WHEN doc_id % 3 = 0 THEN 'deep_learning' END], lambda x: x IS NOT NULL))) AS tags FROM documents")
def domain_tags(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    line = F.concat(F.lit("Keywords: "), F.get(F.array(*map(F.lit, _TOPICS)), (k % 4).cast("int")), F.when(k % 3 == 0, "; ATTENTION").otherwise("; sources"))
    return table(spark, d, "documents").select("doc_id", T.domain_tags(T.keyword_line(F.concat("text", F.lit("\n"), line))).alias("tags"))


@query(r"""SELECT doc_id, list_filter([CASE WHEN len(regexp_extract_all(text, '\b[a-z] [A-Z][a-z]')) > 5 THEN 'broken_words' END, CASE WHEN len(regexp_extract_all(text, '[ \t]{2,}|\n{2,}')) * 20 > greatest(length(text), 1) THEN 'whitespace' END,
  CASE WHEN regexp_matches(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]') THEN 'control_chars' END, CASE WHEN len(list_filter(string_split(text, chr(10)), lambda x: length(x) > 500)) * 10 > len(string_split(text, chr(10))) * 3 THEN 'long_lines' END], lambda x: x IS NOT NULL) AS flags FROM documents""")
def artifact_flags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.artifact_flags(F.col("text")).alias("flags"))


_LINES = (
    "Copyright 2021", "This is a preprint of the paper accepted for publication in Nature", "A long remark that only mentions a preprint in passing, and more", "arXiv:2505.01234", "Under review at some venue", "doi: 10.1234/abc", "https://arxiv.org/abs/2505.01234v2",
    "Received 1 May; Accepted 2 June; Published 3 July", "Peer-review under responsibility of the committee", "All rights reserved.", "© 2020 ACM", "Pre-print. Accepted for publication", "downloaded from a server", "confidential draft",
)
_MARK = "+".join(
    rf"length(x) - length(regexp_replace(x, '(?i){p}', '', 'g'))"
    for p in (
        "this is a pre[- ]?print of the paper accepted for publication in", "pre[- ]?print", "accepted for publication", "under review", "copyright [0-9]{4}", r"arxiv:[0-9]{4}\.[0-9]+", r"doi:[ \t]*10\.[0-9]+",
        r"https?://(?:www\.)?arxiv\.org/abs/", "received.*?accepted.*?published", "peer-review under responsibility of", "all rights reserved", "© [0-9]{4}",
    )
)
_MARKED = "text || chr(10) || (" + str([*_LINES]) + ")[1 + doc_id % " + str(len(_LINES)) + "]"


@query(f"SELECT doc_id, len(list_filter(l, lambda x: length(x) < 200 AND ({_MARK}) * 2 > length(x))) AS n_marks, length(array_to_string(list_filter(l, lambda x: NOT (length(x) < 200 AND ({_MARK}) * 2 > length(x))), chr(10)))::BIGINT AS n_left FROM (SELECT doc_id, string_split({_MARKED}, chr(10)) AS l FROM documents)")
def watermark_lines(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a line at their end that may be a watermark."""
    extra = F.get(F.array(*map(F.lit, _LINES)), (F.col("doc_id") % len(_LINES)).cast("int"))
    docs = table(spark, d, "documents").select("doc_id", F.concat("text", F.lit("\n"), extra).alias("text"))
    return docs.select("doc_id", F.size(F.filter(F.split("text", "\n"), T.is_watermark)).cast("long").alias("n_marks"), F.length(T.remove_watermarks(F.col("text"))).cast("long").alias("n_left"))


@query(r"""SELECT doc_id, length(array_to_string(list_filter(l, lambda x, i: NOT (regexp_matches(x, '^[ \t]*(?:[Pp]age[ \t]+)?[0-9]{1,4}[ \t]*$') OR ((i <= 3 OR i > len(l) - 2) AND regexp_matches(x, 'arXiv:[0-9]{4}\.[0-9]+')))), chr(10)))::BIGINT AS n
  FROM (SELECT doc_id, string_split('arXiv:2505.01234' || chr(10) || text || chr(10) || 'Page ' || doc_id % 100, chr(10)) AS l FROM documents)""")
def footer_lines(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.lit("arXiv:2505.01234\n"), F.col("text"), F.lit("\nPage "), (F.col("doc_id") % 100).cast("string"))
    return table(spark, d, "documents").select("doc_id", F.length(T.remove_footers(t)).cast("long").alias("n"))


@query()
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    """The whole cleaning pass, compatibility forms included."""
    docs = table(spark, d, "documents").select("doc_id", T.clean(T.fix_encoding(F.col("text"))).alias("text"))
    return T.with_nfkc(docs, "text").select(*_digest("doc_id", "text", F.col("text")))


def _paged(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as documents of pages, without accented letters, whose word boundaries engines see differently."""
    c = table(spark, d, "conversations").select("conv_id", F.struct(F.col("turn").cast("int").alias("page"), F.regexp_replace("text", r"[^\x00-\x7F]", "e").alias("text"), F.length("text").alias("char_count")).alias("p"))
    pages = F.array_sort(F.collect_list("p"))
    return c.groupBy("conv_id").agg(pages.alias("pages")).withColumn("text", F.array_join(F.transform("pages", lambda p: p["text"]), "\n\n"))


_PAGED = r"WITH d AS (SELECT conv_id, string_agg(regexp_replace(text, '[^\x00-\x7F]', 'e', 'g'), chr(10) || chr(10) ORDER BY turn) AS text, count(*) AS p, count(*) FILTER (length(text) < 50) AS e50, sum(length(text)) AS chars FROM conversations GROUP BY conv_id)"
_PARTS = " + ".join("(" + " OR ".join(f"contains(low, '{t}')" for t in ts) + ")::INT" for ts in Q.PARTS.values())
_TERMS = " + ".join(f"contains(low, '{t}')::INT" for t in Q.ACADEMIC)


@query(rf"""{_PAGED}, a AS (SELECT *, length(text) AS n, lower(text) AS low, p * 2500.0 AS x, p <= 10 AS short, chars / p AS mean, {_WORDS.format('text')} AS w FROM d), b AS (SELECT *,
  regexp_matches(substr(low, 1, 3000), '\b(?:abstract|summary|overview)\b') AS abs, regexp_matches(substr(low, 1, 5000), '\b(?:introduction|intro|background)\b') AS intro, list_sum(list_transform(w, lambda v: length(v))) / greatest(len(w), 1) AS size FROM a), s AS (SELECT *,
  CASE WHEN n < 500 THEN 0.2 WHEN n < 1000 THEN 0.4 WHEN n < x * 0.3 AND short THEN 0.75 WHEN n < x * 0.3 THEN 0.6 WHEN n < x * 0.6 AND short THEN 0.9 WHEN n < x * 0.6 THEN 0.8 WHEN n < x * 0.9 THEN 0.9 WHEN n > x * 2 THEN 0.95 ELSE 1 END AS len_,
  (1 - 0.3 * e50 / p) * CASE WHEN short THEN CASE WHEN mean < 200 THEN 0.6 WHEN mean < 500 THEN 0.8 WHEN mean < 1000 THEN 0.9 WHEN mean < 1500 THEN 0.95 ELSE 1 END ELSE CASE WHEN mean < 200 THEN 0.5 WHEN mean < 500 THEN 0.7 WHEN mean < 1000 THEN 0.85 ELSE 1 END END AS cov0,
  least(1.0, (abs::INT + intro::INT + {_PARTS}) / CASE WHEN short AND abs THEN 4.0 ELSE 6.0 END) AS str,
  least(1.0, greatest(0.0, 1.0 - CASE WHEN len(regexp_extract_all(text, '[ \t\n\r\f]+')) > 0.3 * n THEN 0.2 ELSE 0 END - CASE WHEN len(regexp_extract_all(text, '\b[a-z][ \t\n\r\f]+[A-Z][a-z]')) * 1000 > n THEN 0.15 ELSE 0 END
    - CASE WHEN len(w) > 0 AND size < 2 THEN 0.3 WHEN len(w) > 0 AND size > 15 THEN 0.1 ELSE 0 END - CASE WHEN len(regexp_extract_all(text, '[.!?]+[ \t\n\r\f]+')) < 4 THEN 0.1 ELSE 0 END + CASE WHEN {_TERMS} >= 3 THEN 0.1 ELSE 0 END)) AS read FROM b),
  c AS (SELECT *, CASE WHEN p > 20 AND mean > 500 THEN least(1.0, cov0 * 1.1) ELSE cov0 END AS cov FROM s)
  SELECT conv_id, round(CASE WHEN n = 0 THEN 0 ELSE least(1.0, greatest(0.0, CASE WHEN n < 5000 OR short THEN 0.2 * len_ + 0.2 * cov + 0.35 * str + 0.25 * read ELSE 0.3 * len_ + 0.3 * cov + 0.2 * str + 0.2 * read END + CASE WHEN short AND str >= 0.7 AND read >= 0.8 THEN 0.05 ELSE 0 END)) END, 3)::DOUBLE AS score FROM c""")
def extraction_score(spark: SparkSession, d: str) -> DataFrame:
    return _paged(spark, d).select("conv_id", F.round(Q.extraction_score(F.col("text"), F.col("pages")), 3).alias("score"))


@query(rf"""{_PAGED} SELECT conv_id, round(least(1.0, 0.3 * CASE WHEN n >= x * 0.8 THEN 1.0 WHEN n >= x * 0.6 THEN 0.95 WHEN n >= x * 0.4 THEN 0.9 ELSE 0.8 END + 0.3 * (1 - 0.2 * e50 / p)
  + 0.25 * least(1.0, (contains(low, 'abstract')::INT + contains(low, 'introduction')::INT + contains(low, 'references')::INT + 0.5) / 3) + 0.135), 3)::DOUBLE AS score FROM (SELECT *, length(text) AS n, p * 2500 AS x, lower(text) AS low FROM d)""")
def improved_score(spark: SparkSession, d: str) -> DataFrame:
    return _paged(spark, d).select("conv_id", Q.improved_score(F.col("text"), F.col("pages")).alias("score"))


@query()
def enhanced_score(spark: SparkSession, d: str) -> DataFrame:
    meta = Q.metadata_score(F.lit("A title"), F.lit(None).cast("string"), F.size("pages"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string"))
    s = _paged(spark, d).select("conv_id", Q.enhanced_score(F.col("text"), F.col("pages"), meta).alias("s"))
    return s.select("conv_id", *[F.round(F.col(f"s.{k}"), 4).alias(k) for k in ("completeness", "coherence", "structure", "accuracy", "metadata", "consistency", "total", "confidence")], F.col("s.issues").alias("issues"))


@query(rf"""{_PAGED}, a AS (SELECT *, length(text) AS n, {_WORDS.format('text')} AS w, len({_SENT.format('text')}) AS s FROM d), b AS (SELECT *, len(w) AS k, coalesce(list_sum(list_transform(w, lambda v: length(v))), 0) / greatest(len(w), 1) AS m, len(list_filter(w, lambda v: length(v) > 15)) AS l, length(regexp_replace(text, '[ \t\n\r\f]', '', 'g')) AS solid,
  CASE WHEN p <= 5 THEN 500.0 ELSE 1000.0 END AS least_ FROM a) SELECT conv_id, n >= least_ AND solid * 2 >= least_ AND k >= 100 AND (p > 10 OR k >= 50) AND (s >= 2 OR (p <= 5 AND n > 2000)) AND m >= 1.5 AND NOT (p <= 10 AND m > 20 AND l * 10 > k * 3) AND e50 * 2 <= p AS valid FROM b""")
def extraction_valid(spark: SparkSession, d: str) -> DataFrame:
    return _paged(spark, d).select("conv_id", Q.extraction_valid(F.col("text"), F.col("pages")).alias("valid"))


@query("""WITH c AS (SELECT conv_id, list(length(text) ORDER BY turn)[1:3] AS h FROM conversations GROUP BY conv_id) SELECT conv_id, CASE WHEN list_sum(h) / len(h) > 500 THEN 'text-based' WHEN list_sum(h) / len(h) < 100 AND conv_id % 2 = 0 THEN 'scanned' ELSE 'mixed' END AS pdf_type FROM c""")
def pdf_type(spark: SparkSession, d: str) -> DataFrame:
    return _paged(spark, d).select("conv_id", Q.pdf_type(F.col("pages"), F.col("conv_id") % 2 == 0).alias("pdf_type"))


@query("SELECT doc_id, list_filter([CASE WHEN s < 0.95 THEN 'low_score' END, CASE WHEN n_chars < 1000 THEN 'low_density' END, CASE WHEN (doc_id % 10) / 50.0 > 0.05 THEN 'empty_pages' END], lambda x: x IS NOT NULL) AS issues FROM (SELECT *, (doc_id % 23) / 22.0 AS s FROM documents)")
def threshold_issues(spark: SparkSession, d: str) -> DataFrame:
    x = Q.threshold_issues((F.col("doc_id") % 23) / 22.0, F.col("n_chars"), (F.col("doc_id") % 10) / 50.0)
    return table(spark, d, "documents").select("doc_id", x.alias("issues"))


@query()
def chunk_quality(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", Q.chunk_quality(F.col("text")).alias("quality_score"))
