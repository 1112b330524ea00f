"""Joins, upserts, windows and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import relational as R
from ..operators import structure as S
from ..sources import readers, sinks
from ..streaming import incremental
from .registry import query, table

_OFFSETS = """SELECT conv_id, turn, role, text, coalesce(sum(length(text) + 2) OVER w, 0)::BIGINT AS s, (coalesce(sum(length(text) + 2) OVER w, 0) + length(text))::BIGINT AS e FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


@query("SELECT l_partkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY l_partkey")
def dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    return R.keep_first(table(spark, d, "lineitem").select("l_partkey", "l_suppkey"), ["l_partkey"], ["l_suppkey"])


@query("SELECT event_id, event_type FROM events WHERE event_id NOT IN (SELECT min(event_id) FROM events GROUP BY user_id)")
def tracking_anti_join(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "event_type", "user_id")
    return R.anti(e, e.groupBy("user_id").agg(F.min("event_id").alias("event_id")), ["event_id"]).drop("user_id")


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def todo_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return R.anti(table(spark, d, "documents").select("doc_id").distinct(), table(spark, d, "labels"), ["doc_id"])


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1 UNION SELECT conv_id FROM conversations)")
def skip_processed_union(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "documents").select(F.col("doc_id").alias("paper_id"))
    done = table(spark, d, "labels").select(F.col("doc_id").alias("paper_id"), F.when(F.col("quality") == 1, "success").otherwise("failed").alias("status"))
    there = table(spark, d, "conversations").select(F.col("conv_id").alias("paper_id"))
    return incremental.todo(ids, done, there).withColumnRenamed("paper_id", "doc_id")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return R.counts(table(spark, d, "events"), ["event_type"])


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(event_id) FILTER (true) AS any_id, max(ts) AS ts FROM events GROUP BY user_id")
def progress_latest(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    last = R.latest(e, ["user_id"], ["ts", "event_id"]).select("user_id", "event_type", "ts")
    return last.join(e.groupBy("user_id").agg(F.max("event_id").alias("any_id")), "user_id")


@query("SELECT name, count(*) AS n FROM orders JOIN (VALUES ('1-URGENT', 'urgent'), ('2-HIGH', 'high'), ('3-MEDIUM', 'medium'), ('4-NOT SPECIFIED', 'none'), ('5-LOW', 'low')) v(code, name) ON o_orderpriority = code GROUP BY name")
def category_lookup(spark: SparkSession, d: str) -> DataFrame:
    dim = spark.createDataFrame([("1-URGENT", "urgent"), ("2-HIGH", "high"), ("3-MEDIUM", "medium"), ("4-NOT SPECIFIED", "none"), ("5-LOW", "low")], "code string, name string")
    o = table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("c"))
    return o.join(F.broadcast(dim), F.col("o_orderpriority") == F.col("code")).groupBy("name").agg(F.sum("c").alias("n"))  # five rows


@query("SELECT r_name AS category, n_name AS paper_id FROM nation, region UNION ALL SELECT 'ASIA', 'x1'")
def bare_id_fanout(spark: SparkSession, d: str) -> DataFrame:
    names = [r.r_name for r in table(spark, d, "region").orderBy("r_regionkey").collect()]  # the five regions
    lines = table(spark, d, "nation").select(F.col("n_name").alias("value")).union(spark.createDataFrame([("ASIA|x1",), ("",), ("NOWHERE|x2",)], "value string"))
    return readers.parse_ids(lines, names)


@query("SELECT doc_id, coalesce(quality, -1)::BIGINT AS quality, coalesce(toxic, 0)::BIGINT AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def metadata_merge(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return j.select("doc_id", F.coalesce("quality", F.lit(-1)).cast("long").alias("quality"), F.coalesce("toxic", F.lit(0)).cast("long").alias("toxic"))


def _kept(spark: SparkSession, d: str, missing: float, least: float) -> DataFrame:
    j = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return j.where(F.coalesce(F.col("quality").cast("double"), F.lit(missing)) >= least).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(quality, 0) >= 0.9")
def quality_filter_default0(spark: SparkSession, d: str) -> DataFrame:
    return _kept(spark, d, 0.0, 0.9)


@query("SELECT count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(quality, 1) >= 0.7")
def quality_filter_default1(spark: SparkSession, d: str) -> DataFrame:
    return _kept(spark, d, 1.0, 0.7)


def _parts(spark: SparkSession, d: str) -> DataFrame:
    return R.offsets(table(spark, d, "conversations"), "conv_id", "turn", F.length("text"))


@query(f"SELECT conv_id, turn, s AS start, e AS \"end\" FROM ({_OFFSETS})")
def page_offsets(spark: SparkSession, d: str) -> DataFrame:
    return _parts(spark, d).select("conv_id", "turn", "start", "end")


_PROBES = "SELECT conv_id, unnest([0, 500, 1500, 100000]) AS pos FROM (SELECT DISTINCT conv_id FROM conversations)"


@query(f"""WITH o AS ({_OFFSETS}), p AS ({_PROBES}) SELECT p.conv_id, p.pos::BIGINT AS pos, coalesce(max(o.turn) FILTER (o.s <= pos AND pos < o.e), max(o.turn) FILTER (pos >= o.e AND o.e = m.e), -1)::BIGINT AS turn
  FROM p JOIN o USING (conv_id) JOIN (SELECT conv_id, max(e) AS e FROM o GROUP BY conv_id) m USING (conv_id) GROUP BY p.conv_id, p.pos""")
def position_to_page(spark: SparkSession, d: str) -> DataFrame:
    spans = _parts(spark, d).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "turn"))).alias("spans"))
    p = spans.withColumn("pos", F.explode(F.array(*[F.lit(x).cast("long") for x in (0, 500, 1500, 100000)])))
    return p.select("conv_id", "pos", F.coalesce(R.span_at(F.col("spans"), F.col("pos"), "turn"), F.lit(-1)).cast("long").alias("turn"))


@query(f"WITH o AS ({_OFFSETS}), p AS ({_PROBES}) SELECT conv_id, pos::BIGINT AS pos, role FROM p JOIN o USING (conv_id) WHERE s <= pos AND pos < e")
def section_interval_join(spark: SparkSession, d: str) -> DataFrame:
    o = _parts(spark, d).select("conv_id", "role", "start", "end")
    p = o.select("conv_id").distinct().withColumn("pos", F.explode(F.array(*[F.lit(x).cast("long") for x in (0, 500, 1500, 100000)])))
    return R.interval_join(p, o, "conv_id", "pos", "start", "end").select("conv_id", "pos", "role")


@query("""WITH c AS (SELECT conv_id, count(*) AS n, avg(length(text)) AS m, stddev_pop(length(text)) AS sd, count(*) FILTER (length(text) < 50) AS e FROM conversations GROUP BY conv_id)
  SELECT conv_id, round(CASE WHEN n <= 1 THEN 1.0 ELSE (CASE WHEN coalesce(sd / nullif(m, 0), 0) < 0.3 THEN 1.0 WHEN coalesce(sd / nullif(m, 0), 0) < 0.5 THEN 0.8 WHEN coalesce(sd / nullif(m, 0), 0) < 0.8 THEN 0.6 ELSE 0.4 END) * (1 - 0.5 * e / n) END, 4)::DOUBLE AS score FROM c""")
def page_consistency(spark: SparkSession, d: str) -> DataFrame:
    from ..functions import quality as Q

    pages = table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct(F.col("turn").alias("page"), "text", F.length("text").alias("char_count"))).alias("pages"))
    return pages.select("conv_id", F.round(Q.consistency(F.col("pages")), 4).alias("score"))


@query("SELECT conv_id, turn, coalesce(lead(turn) OVER w, 9999)::BIGINT AS next_turn FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def section_end_lead(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, d, "conversations").select("conv_id", "turn", F.coalesce(F.lead("turn").over(w), F.lit(9999)).cast("long").alias("next_turn"))


@query("SELECT conv_id, count(*) FILTER (j) AS jumps FROM (SELECT conv_id, coalesce(lead(l) OVER (PARTITION BY conv_id ORDER BY turn) > l + 1, false) AS j FROM (SELECT conv_id, turn, length(text) % 4 AS l FROM conversations)) GROUP BY conv_id")
def level_jumps(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, d, "conversations").withColumn("l", F.length("text") % 4)
    return c.withColumn("j", F.coalesce(F.lead("l").over(w) > F.col("l") + 1, F.lit(False))).groupBy("conv_id").agg(F.count_if("j").alias("jumps"))


@query("SELECT conv_id, role, min(turn) AS first_turn, max(turn) AS last_turn FROM conversations GROUP BY conv_id, role")
def section_index_minmax(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").groupBy("conv_id", "role").agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"))


@query("SELECT vec_id, ((row_number() OVER (ORDER BY vec_id) - 1) // 64)::BIGINT AS batch_index, ((row_number() OVER (ORDER BY vec_id) - 1) % 64)::BIGINT AS batch_position FROM embeddings")
def batch_slicing(spark: SparkSession, d: str) -> DataFrame:
    return R.batches(table(spark, d, "embeddings").select("vec_id"), ["vec_id"], 64).drop("position")


@query("SELECT count(*) AS total, max(len(embedding))::BIGINT AS dim, ceil(count(*) / 64)::BIGINT AS num_batches FROM embeddings")
def embedding_index_row(spark: SparkSession, d: str) -> DataFrame:
    return sinks.embedding_index(table(spark, d, "embeddings"), "embedding", 64)


@query("SELECT event_id FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS p FROM events) WHERE p > 500")
def resume_after_index(spark: SparkSession, d: str) -> DataFrame:
    return incremental.resume_after(table(spark, d, "events").select("event_id"), "event_id", 500)


_RUNS = """SELECT user_id, event_id, event_type, count(*) OVER (PARTITION BY user_id, g) AS run_length, row_number() OVER (PARTITION BY user_id, g ORDER BY event_id) AS run_place FROM (
  SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM (SELECT *, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) THEN 0 ELSE 1 END AS new FROM events))"""


@query(f"SELECT user_id, event_type, count(*) AS n FROM ({_RUNS}) WHERE run_length >= 2 AND run_place <= run_length - 1 GROUP BY user_id, event_type")
def repeated_runs(spark: SparkSession, d: str) -> DataFrame:
    r = R.runs(table(spark, d, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id", "event_type")
    return r.where("run_length >= 2 and run_place <= run_length - 1").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH l AS (SELECT conv_id, turn, list_distinct(list_filter(list_concat(ls[1:3], ls[greatest(1, len(ls) - 2):]), lambda x: x <> '')) AS ends FROM (SELECT conv_id, turn, list_transform(string_split('Head of ' || conv_id || chr(10) || text || CASE WHEN turn % 4 = 0 THEN '' ELSE chr(10) || ' foot ' END, chr(10)), lambda x: regexp_replace(x, '^[ \\t\\n\\r\\f]+|[ \\t\\n\\r\\f]+$', '', 'g')) AS ls FROM conversations)),
  v AS (SELECT conv_id, line, count(DISTINCT turn) AS votes FROM (SELECT conv_id, turn, unnest(ends) AS line FROM l) GROUP BY 1, 2), n AS (SELECT conv_id, count(DISTINCT turn) AS parts FROM conversations GROUP BY 1)
  SELECT conv_id, line, votes, parts FROM v JOIN n USING (conv_id) WHERE votes >= greatest(2, floor(parts * 0.7))""")
def header_footer_votes(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("Head of "), F.col("conv_id").cast("string"), F.lit("\n"), F.col("text"), F.when(F.col("turn") % 4 == 0, "").otherwise("\n foot "))
    return S.voted_lines(table(spark, d, "conversations").withColumn("text", text), "conv_id", "turn").select("conv_id", "line", "votes", "parts")


@query("SELECT n_name AS name FROM nation UNION SELECT r_name FROM region")
def union_distinct(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(F.col("n_name").alias("name")).union(table(spark, d, "region").select("r_name")).distinct()


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def events_hourly(spark: SparkSession, d: str) -> DataFrame:
    return incremental.windowed_counts(table(spark, d, "events"), "ts", ["event_type"])


@query("SELECT c.item_id AS query_id, b.item_id FROM benchmark c JOIN benchmark b ON lower(trim('  ' || c.text || ' ')) = lower(trim(b.text))")
def benchmark_lookup(spark: SparkSession, d: str) -> DataFrame:
    key = lambda c: F.lower(F.trim(c))
    b = table(spark, d, "benchmark")
    asked = b.select(F.col("item_id").alias("query_id"), key(F.concat(F.lit("  "), F.col("text"), F.lit(" "))).alias("k"))
    return asked.join(b.select("item_id", key(F.col("text")).alias("k")), "k").drop("k")


@query("SELECT doc_id, text IS NOT NULL AND length(text) >= 50 AS kept_by_length, NOT starts_with(source, '._') AS kept_by_name, CASE WHEN n_chars <= 2000 * 5 THEN 0.70 WHEN n_chars > 2000 * 30 THEN 0.90 ELSE 0.85 END::DOUBLE AS ocr_threshold FROM documents")
def file_filters(spark: SparkSession, d: str) -> DataFrame:
    t = F.when(F.col("n_chars") <= 10000, 0.70).when(F.col("n_chars") > 60000, 0.90).otherwise(0.85)
    return table(spark, d, "documents").select("doc_id", (F.col("text").isNotNull() & (F.length("text") >= 50)).alias("kept_by_length"), (~F.startswith("source", F.lit("._"))).alias("kept_by_name"), t.alias("ocr_threshold"))
