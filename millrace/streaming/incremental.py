"""Incremental processing: file streams with checkpoints, idempotent upserts, positional resume and a content cache."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def process_files(spark: SparkSession, folder: str, schema: str, step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, fmt: str = "parquet", files: int = 10) -> StreamingQuery:
    """Every file once: what the checkpoint has seen is skipped on the next run. The sink's own log makes reruns of a batch
    harmless."""
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(fmt).load(folder)
    return step(src).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_stream(src: DataFrame, key: list[str], order: list[str], table: str, checkpoint: str) -> StreamingQuery:
    """Keeps the last row of every key. Each batch writes its own folder, named by its id, so that a repeated batch replaces
    itself; ``current`` reads them all."""

    def write(batch: DataFrame, i: int) -> None:
        rows = batch.groupBy(*key).agg(F.max_by(F.struct(*[c for c in batch.columns if c not in key]), F.struct(*order)).alias("r")).select(*key, "r.*")
        rows.write.mode("overwrite").parquet(f"{table}/batch={i}")

    return src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, table: str, key: list[str], order: list[str]) -> DataFrame:
    rows = spark.read.parquet(table).drop("batch")
    return rows.groupBy(*key).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in key]), F.struct(*order)).alias("r")).select(*key, "r.*")


def compact(spark: SparkSession, table: str, key: list[str], order: list[str], out: str) -> None:
    """Writes the current rows as the first batch of a new table, which the stream can go on with."""
    current(spark, table, key, order).write.mode("overwrite").parquet(f"{out}/batch=-1")


def todo(ids: DataFrame, progress: DataFrame, existing: DataFrame) -> DataFrame:
    """Ids that are neither processed with success nor present in the output."""
    done = progress.where("status = 'success'").select("paper_id").union(existing.select("paper_id")).distinct()
    return ids.join(done, "paper_id", "left_anti")


def resume_after(ids: DataFrame, order: str, last_index: int) -> DataFrame:
    from ..operators.relational import numbered

    return numbered(ids, [order]).where(F.col("position") > last_index).drop("position")


def cached(inputs: DataFrame, cache: DataFrame, days: int = 7) -> tuple[DataFrame, DataFrame]:
    """(hits with their result, misses). inputs: path, content, size, mtime; cache: cache_key, result, last_accessed."""
    key = F.sha2(F.concat_ws("|", F.sha2("content", 256), F.col("size").cast("string"), F.col("mtime").cast("string")), 256)
    fresh = cache.where(F.col("last_accessed") >= F.current_timestamp() - F.expr(f"INTERVAL {days} DAYS"))
    keyed = inputs.withColumn("cache_key", key)
    return keyed.join(fresh, "cache_key"), keyed.join(fresh, "cache_key", "left_anti")


def evict(cache: DataFrame, limit: int) -> DataFrame:
    """The entries last used that fit into four fifths of ``limit`` bytes, once all exceed it. One row per entry and a window
    over the bytes of days, so no task holds all entries."""
    day = cache.withColumn("day", F.to_date("last_accessed"))
    days = day.groupBy("day").agg(F.sum("size").alias("b")).withColumn("later", F.coalesce(F.sum("b").over(Window.orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    w = Window.partitionBy("day").orderBy(F.desc("last_accessed"), "cache_key").rowsBetween(Window.unboundedPreceding, 0)
    total = days.agg(F.sum("b").alias("total"))
    kept = day.join(days.select("day", "later"), "day").withColumn("upto", F.sum("size").over(w) + F.col("later")).crossJoin(F.broadcast(total))
    return kept.where((F.col("total") <= limit) | (F.col("upto") <= 0.8 * limit)).select(*cache.columns)


def windowed_counts(events: DataFrame, ts: str, by: list[str], width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by event time; on a stream, rows later than the watermark are left out. An extension."""
    src = events.withWatermark(ts, late) if events.isStreaming else events
    return src.groupBy(F.window(ts, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), *by, "n")
