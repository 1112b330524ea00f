"""Chunkers, their repair, and incremental runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chunking as K
from ..streaming import incremental
from .registry import query, table
from .texts import _SENT, _STRIP, _WORDS


_SENTENCES = f"""WITH r AS (SELECT doc_id, list_reduce(list_transform({_SENT.format('text')}, lambda x: {{'d': CAST([] AS VARCHAR[]), 'c': [x], 'n': length(x) + 1}}),
  lambda a, b: CASE WHEN a.n + b.n - 1 > {K.SIZE} THEN {{'d': list_append(a.d, array_to_string(a.c, ' ')), 'c': list_concat(a.c[len(a.c) - list_max(list_filter(generate_series(0, len(a.c)), lambda k: k = 0 OR length(array_to_string(a.c[len(a.c) - k + 1:], ' ')) <= {K.OVERLAP})) + 1:], b.c),
    'n': (coalesce(list_sum(list_transform(a.c[len(a.c) - list_max(list_filter(generate_series(0, len(a.c)), lambda k: k = 0 OR length(array_to_string(a.c[len(a.c) - k + 1:], ' ')) <= {K.OVERLAP})) + 1:], lambda y: length(y) + 1)), 0) + b.n)::BIGINT}}
  ELSE {{'d': a.d, 'c': list_concat(a.c, b.c), 'n': a.n + b.n}} END) AS s FROM documents WHERE len({_SENT.format('text')}) > 0), c AS (SELECT doc_id, list_filter(list_append(s.d, array_to_string(s.c, ' ')), lambda x: length(x) >= {K.LEAST}) AS l FROM r)
  SELECT doc_id, unnest(generate_series(0, len(l) - 1)) AS chunk_index, unnest(list_transform(l, lambda x: length(x)))::BIGINT AS n, unnest(list_transform(l, lambda x: md5(x))) AS digest FROM c"""


@query(_SENTENCES)
def sentence_chunks(spark: SparkSession, d: str) -> DataFrame:
    c = K.by_sentence(table(spark, d, "documents"))
    return c.select("doc_id", "chunk_index", F.length("text").cast("long").alias("n"), F.md5("text").alias("digest"))


@query()
def fixed_chunks(spark: SparkSession, d: str) -> DataFrame:
    c = K.fixed(table(spark, d, "documents"))
    return c.select("doc_id", "chunk_index", "char_start", "char_end", F.length("text").cast("long").alias("n"))


@query()
def semantic_chunks(spark: SparkSession, d: str) -> DataFrame:
    return K.by_similarity(table(spark, d, "documents")).select("doc_id", "chunk_index", F.length("text").cast("long").alias("n"))


@query("SELECT doc_id, 0 AS n_long, count(*) AS n_whole FROM documents WHERE length(text) <= 1500 GROUP BY doc_id")
def split_short_untouched(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where(F.length("text") <= 1500)
    c = K.parts_of_chunks(docs.select("doc_id", F.lit(0).alias("chunk_index"), "text"), 1500)
    g = c.groupBy("doc_id").agg(F.count_if(F.col("chunk_length") > 1500).alias("n_long"), F.count_if(~F.col("is_split")).alias("n_whole"))
    return g.where("n_whole = 1").select("doc_id", F.lit(0).alias("n_long"), "n_whole")


_SPLIT = rf"""WITH p AS (SELECT doc_id, text, length(text) > 1500 AS long, list_reduce(list_transform(string_split(regexp_replace(text, '([.!?])[ \t\n\r\f]+', '\1␞', 'g'), '␞'), lambda x: {{'d': CAST([] AS VARCHAR[]), 'c': x}}),
  lambda a, b: CASE WHEN a.c <> '' AND length(a.c) + length(b.c) + 1 > 1500 THEN {{'d': list_append(a.d, a.c), 'c': b.c}} ELSE {{'d': a.d, 'c': CASE WHEN a.c = '' THEN b.c ELSE a.c || ' ' || b.c END}} END) AS s FROM documents),
  l AS (SELECT doc_id, CASE WHEN long THEN list_transform(list_append(s.d, s.c), lambda x: {_STRIP.format('x')}) ELSE [text] END AS l FROM p),
  u AS (SELECT doc_id, len(l) AS k, unnest(l) AS x, generate_subscripts(l, 1) - 1 AS i FROM l)
  SELECT doc_id, CASE WHEN k > 1 THEN '0.' || i ELSE '0' END AS chunk_index, k > 1 AS is_split, k::BIGINT AS split_total, length(x)::BIGINT AS chunk_length, len({_WORDS.format('x')})::BIGINT AS word_count FROM u"""


@query(_SPLIT)
def split_oversize(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "documents").select("doc_id", F.lit(0).alias("chunk_index"), "text")
    return K.parts_of_chunks(c, 1500).select("doc_id", "chunk_index", "is_split", "split_total", "chunk_length", "word_count")


@query()
def fix_pipeline_stats(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "documents").select("doc_id", F.lit(0).alias("chunk_index"), "text", F.col("source").alias("title"), F.col("lang").alias("section"))
    f = K.fix_pipeline(c)
    return f.agg(F.countDistinct("doc_id").alias("documents"), F.count(F.lit(1)).alias("final_chunks"), F.count_if("is_split").alias("split_parts"), F.max("chunk_length").alias("longest"))


@query("SELECT count(*) AS original, count(*) FILTER (length(text) < 50) AS filtered, count(*) FILTER (length(text) >= 50) AS kept FROM documents")
def fix_filter_counts(spark: SparkSession, d: str) -> DataFrame:
    n = F.length("text")
    return table(spark, d, "documents").agg(F.count(F.lit(1)).alias("original"), F.count_if(n < 50).alias("filtered"), F.count_if(n >= 50).alias("kept"))


@query("SELECT doc_id, length(text)::BIGINT AS n FROM documents")
def incremental_equals_batch(spark: SparkSession, d: str) -> DataFrame:
    """A file stream over the documents, run twice: the second run finds nothing new."""
    from ..sources.shared import scratch_dir

    base = scratch_dir(spark)
    step = lambda df: df.select("doc_id", F.length("text").cast("long").alias("n"))
    table(spark, d, "documents").select("doc_id", "text").write.parquet(f"{base}/in")
    for _ in range(2):
        incremental.process_files(spark, f"{base}/in", "doc_id long, text string", step, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query()
def light_payload(spark: SparkSession, d: str) -> DataFrame:
    """Per document: plain text's digest, tokens, readability, summary and mail addresses."""
    from ..functions import identifiers as I

    t = F.col("text")
    plain = F.array_join(F.slice(T.words(t), 1, 6000), " ")
    return table(spark, d, "documents").select("doc_id", F.md5(F.when(T.token_estimate(t) > 8000, plain).otherwise(t)).alias("plain"), T.token_estimate(t).alias("tokens"), F.round(T.flesch(t), 4).alias("flesch"), T.summary(t).alias("summary"), F.sort_array(I.emails(t)).alias("contacts"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Sentence chunks by source: how many, how long, and in which size bands."""
    docs = table(spark, d, "documents")
    c = docs.select("source", F.explode(K.packed(T.sentences(F.col("text")), K.SIZE, K.OVERLAP)).alias("chunk")).withColumn("n", F.length("chunk"))
    return c.groupBy("source").agg(F.count(F.lit(1)).alias("n_chunks"), F.round(F.avg("n"), 4).alias("avg_size"), F.min("n").cast("long").alias("min_size"), F.max("n").cast("long").alias("max_size"), F.count_if(F.col("n") < 50).alias("n_short"))


