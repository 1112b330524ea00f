"""Sinks: papers, logs, progress, embeddings and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import anti, batches, latest


def papers(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Partitioned as the input is: category and year_month."""
    df.write.mode("overwrite").partitionBy("category", "year_month").format(fmt).save(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def upsert(spark: SparkSession, old: DataFrame, new: DataFrame, path: str, key: list[str], order: list[str]) -> DataFrame:
    """Writes the current rows of both to a new place."""
    latest(old.unionByName(new), key, order).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def embedding_batches(df: DataFrame, path: str, order: list[str], size: int = 10_000) -> None:
    batches(df, order, size).drop("position").write.mode("overwrite").partitionBy("batch_index").parquet(path)


def embedding_index(df: DataFrame, vector: str, size: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), F.max(F.size(vector)).cast("long").alias("dim"), F.ceil(F.count(F.lit(1)) / size).cast("long").alias("num_batches"))


def collection(df: DataFrame, path: str) -> None:
    """Vector-store records: id, embedding, document and flat metadata without nulls."""
    out = df.select(
        F.col("chunk_id").alias("id"), "embedding", F.col("text").alias("document"), F.coalesce("paper_id", F.lit("unknown")).alias("paper_id"), F.coalesce("section", F.lit("unknown")).alias("section"),
        F.coalesce("quality_score", F.lit(0.0)).cast("float").alias("quality_score"), F.col("chunk_index").cast("string").alias("chunk_index"),
    )
    out.write.mode("overwrite").parquet(path)


def without_removed(log: DataFrame, removed: DataFrame, prefix: str = "") -> DataFrame:
    """Tracking rows whose path is not among the removed ones."""
    return anti(log, removed.select(F.concat(F.lit(prefix), F.col("path")).alias("path")), ["path"])


def report(df: DataFrame) -> DataFrame:
    """A one-row report as (metric, value)."""
    return df.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, df.columns)), F.array(*[F.col(c).cast("string") for c in df.columns]))).alias("metric", "value"))
