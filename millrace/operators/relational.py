"""Relational building blocks: dedup, upsert, interval lookup, positional batches, gaps and islands, top-k."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..sources.shared import scratch_dir


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of every key by ``order``; combined before the shuffle, so a hot key costs one row a task."""
    rest = [c for c in df.columns if c not in {*key, *order}]
    row = F.struct(*order, *rest)
    picked = df.groupBy(*key).agg(F.min(row).alias("_r")) if not rest else df.groupBy(*key).agg(F.min_by(row, F.struct(*order)).alias("_r"))
    return picked.select(*[F.col(c) if c in key else F.col(f"_r.{c}").alias(c) for c in df.columns])


def latest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """An upsert log's current rows: the last of every key by ``order``."""
    row = F.struct(*[c for c in df.columns if c not in key])
    return df.groupBy(*key).agg(F.max_by(row, F.struct(*order)).alias("_r")).select(*key, "_r.*")


def anti(df: DataFrame, gone: DataFrame, on: list[str]) -> DataFrame:
    return df.join(gone.select(*on), on, "left_anti")


def span_at(spans: Column, position: Column, field: str, past: Column | None = None) -> Column:
    """The ``field`` of the first span [start, end) that holds a position; past the last one, its field; else ``past``.

    The spans lie in the row, so no range join is needed."""
    hit = F.filter(spans, lambda s: (s["start"] <= position) & (position < s["end"]))
    last = F.try_element_at(spans, F.lit(-1))
    beyond = F.when(position >= last["end"], last[field])
    out = [F.try_element_at(hit, F.lit(1))[field], beyond]
    return F.coalesce(*out, past) if past is not None else F.coalesce(*out)


def interval_join(points: DataFrame, spans: DataFrame, key: str, position: str, start: str, end: str, bin_size: int = 1024) -> DataFrame:
    """Points with the spans that hold them, for long tables: both sides meet on (key, bin), a hash join."""
    cut = spans.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / bin_size), F.floor((F.col(end) - 1) / bin_size)))).where(F.col(end) > F.col(start))
    return points.withColumn("_bin", F.floor(F.col(position) / bin_size)).join(cut, [key, "_bin"]).where((F.col(position) >= F.col(start)) & (F.col(position) < F.col(end))).drop("_bin")


def offsets(df: DataFrame, key: str, order: str, length: Column, gap: int = 2) -> DataFrame:
    """start and end of every part of a document that is joined with ``gap`` characters between parts."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    begun = F.coalesce(F.sum(length + gap).over(w), F.lit(0))
    return df.withColumn("start", begun.cast("long")).withColumn("end", (begun + length).cast("long"))


def numbered(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Global positions from 0 without a single-task window: rows are range partitioned once and stored with their partition
    and their place in it, so that all that follows reads the same ones; a partition's offset is the number of rows before it,
    one count per partition, which are broadcast."""
    spark, names = df.sparkSession, [*df.columns, "_p", "_i"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, i = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(n, p, np.int32)), pa.array(np.arange(i, i + n))], names=names)
            i += n

    schema = StructType([*df.schema.fields, StructField("_p", IntegerType()), StructField("_i", LongType())])
    path = scratch_dir(spark)
    df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema).write.parquet(path)
    local = spark.read.schema(schema).parquet(path)
    before = local.groupBy("_p").agg((F.max("_i") + 1).alias("_n"))
    before = before.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return local.join(F.broadcast(before.select("_p", "_before")), "_p").withColumn(name, (F.col("_i") + F.col("_before")).cast("long")).drop("_p", "_i", "_before")


def batches(df: DataFrame, order: list[str], size: int) -> DataFrame:
    n = numbered(df, order)
    return n.withColumn("batch_index", F.floor(F.col("position") / size).cast("long")).withColumn("batch_position", (F.col("position") % size).cast("long"))


def islands(df: DataFrame, key: list[str], order: list[str], starts: Column, name: str = "island") -> DataFrame:
    """A running number of the stretch a row is in; a row with ``starts`` begins the next one."""
    return df.withColumn(name, F.sum(F.coalesce(starts, F.lit(False)).cast("int")).over(Window.partitionBy(*key).orderBy(*order)).cast("long"))


def runs(df: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """Length of the run of equal neighbouring values that a row is in, and its place there from 1."""
    w = Window.partitionBy(*key).orderBy(order)
    new = (F.col(value) != F.lag(value).over(w)) | F.lag(value).over(w).isNull()
    out = islands(df, key, [order], new, "_run")
    return out.withColumn("run_length", F.count(F.lit(1)).over(Window.partitionBy(*key, "_run"))).withColumn("run_place", F.row_number().over(Window.partitionBy(*key, "_run").orderBy(order))).drop("_run")


def sampled(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A seeded sample that every engine draws alike: the n smallest hashes."""
    h = F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def counts(df: DataFrame, by: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
