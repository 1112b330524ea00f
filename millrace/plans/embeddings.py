"""Vector queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import vectors as V
from .registry import query, table

_D = "list_transform({}, lambda x: x::DOUBLE)"


@query(f"SELECT vec_id, round(sqrt(list_sum(list_transform({_D.format('embedding')}, lambda x: x * x))), 5)::DOUBLE AS norm FROM embeddings")
def l2_normalise_check(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.round(V.norm(F.col("embedding")), 5).alias("norm"))


@query(f"SELECT label, vec_id, round(list_cosine_similarity({_D.format('embedding')}, {_D.format('p')}), 5)::DOUBLE AS cos, coalesce(round(list_cosine_similarity({_D.format('embedding')}, {_D.format('p')}), 5) < 0.7, false) AS cut FROM (SELECT label, vec_id, embedding, lag(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS p FROM embeddings)")
def cosine_consecutive(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("label").orderBy("vec_id")
    e = table(spark, d, "embeddings").withColumn("p", F.lag("embedding").over(w))
    c = F.round(V.cosine(F.col("embedding"), F.col("p")), 5)
    return e.select("label", "vec_id", c.alias("cos"), F.coalesce(c < 0.7, F.lit(False)).alias("cut"))


@query("SELECT doc_id, 64 AS dim, vec_id IS NULL AS is_padded FROM documents LEFT JOIN embeddings ON doc_id = vec_id")
def vector_pad_truncate(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "documents").select("doc_id").join(table(spark, d, "embeddings"), F.col("doc_id") == F.col("vec_id"), "left")
    return j.select("doc_id", F.size(V.padded(F.col("embedding"), 64)).alias("dim"), F.col("vec_id").isNull().alias("is_padded"))


@query(f"""SELECT query_id, rank, vec_id, score FROM (SELECT q.vec_id AS query_id, b.vec_id, round(list_cosine_similarity({_D.format('q.embedding')}, {_D.format('b.embedding')}), 6)::DOUBLE AS score,
  row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity({_D.format('q.embedding')}, {_D.format('b.embedding')}), 6) DESC, b.vec_id) AS rank FROM embeddings q JOIN embeddings b ON q.vec_id <> b.vec_id WHERE q.vec_id % 50 = 0) WHERE rank <= 5""")
def topk_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The rows whose id is divisible by 50 as queries, against all rows. An extension."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return V.nearest(e.where("id % 50 = 0"), e, 5)


@query()
def hashed_embeddings(spark: SparkSession, d: str) -> DataFrame:
    e = V.encode(table(spark, d, "documents").select("doc_id", "text"), "text", V.hashing_encoder(64), 64)
    return e.select("doc_id", F.size("embedding").alias("dim"), F.round(V.norm(F.col("embedding")), 4).alias("norm"))
