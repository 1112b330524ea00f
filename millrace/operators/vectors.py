"""Vectors: norms, cosine, nearest neighbours in blocks, batches of embeddings, and encoders."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, FloatType, StringType, StructField, StructType


def doubles(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine(a: Column, b: Column) -> Column:
    """Null for a zero vector."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def normalised(v: Column) -> Column:
    n = norm(v)
    return F.when(n > 0, F.transform(v, lambda x: x.cast("double") / n)).otherwise(doubles(v))


def padded(v: Column, dim: int) -> Column:
    """Missing vectors as zeros."""
    return F.coalesce(v, F.array_repeat(F.lit(0.0).cast("float"), dim))


#: Texts, and their characters, that an encoder is given at once.
PIECE, PIECE_CHARS = 1024, 1 << 20


def _pieces(texts: pa.Array) -> Iterator[list[str]]:
    """Texts, empty ones for missing, in lists of bounded size; only one list is out of Arrow's buffers at a time."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        full = np.searchsorted(size, (size[at - 1] if at else 0) + PIECE_CHARS, "right")
        end = min(max(int(full), at + 1), at + PIECE, len(texts))
        yield [t or "" for t in texts.slice(at, end - at).to_pylist()]
        at = end


def _unit_vectors(model: Callable[[list[str]], np.ndarray], rows: list[str], dim: int) -> tuple[np.ndarray, list[str | None]]:
    errors: list[str | None] = [None] * len(rows)
    try:
        x = np.asarray(model(rows), np.float32)
    except Exception:
        x = np.zeros((len(rows), dim), np.float32)
        for i, r in enumerate(rows):
            try:
                x[i] = model([r])[0]
            except Exception as e:  # a model may fail in any way
                errors[i] = f"{type(e).__name__}: {e}"
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0), errors


def encode(texts: DataFrame, column: str, encoder: Callable[[], Callable[[list[str]], np.ndarray]], dim: int, out: str = "embedding", failed: str | None = None) -> DataFrame:
    """Adds unit vectors. ``encoder`` is called once a worker and gives a function of a list of texts; a list that fails is
    encoded text by text, and a text that fails has a zero vector and, in the column that ``failed`` names, the error."""

    @F.arrow_udf(StructType([StructField("v", ArrayType(FloatType())), StructField("error", StringType())]))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = encoder()
        for s in batches:
            found = [_unit_vectors(model, rows, dim) for rows in _pieces(s)]
            x = np.concatenate([v for v, _ in found]) if found else np.zeros((0, dim), np.float32)
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
            yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, pa.array(x.ravel())), pa.array([e for _, es in found for e in es], pa.string())], names=["v", "error"])

    rows = texts.withColumn("_e", run(F.col(column))).withColumn(out, F.col("_e.v"))
    return (rows.withColumn(failed, F.col("_e.error")) if failed else rows).drop("_e")


def breaks(texts: Column, encoder: Callable[[], Callable[[list[str]], np.ndarray]], dim: int, least: float) -> Column:
    """For an array of texts, whether the cosine of each to the one before is below ``least``; false for the first."""

    @F.arrow_udf(ArrayType(BooleanType()))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = encoder()
        for b in batches:
            last, far = None, [np.zeros(0, bool)]
            for rows in _pieces(b.flatten()):
                x, _ = _unit_vectors(model, rows, dim)
                x = x.astype(np.float64)
                before = np.concatenate([x[:1] if last is None else last, x[:-1]])
                far.append(np.cumsum(x * before, axis=1)[:, -1] < least)  # summed up in order, as ``dot`` does
                last = x[-1:]
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(b), 0).to_numpy())]).astype(np.int32)
            flat = np.concatenate(far)
            flat[ends[:-1][ends[:-1] < ends[1:]]] = False
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return run(texts)


def hashing_encoder(dim: int = 64) -> Callable[[], Callable[[list[str]], np.ndarray]]:
    """A deterministic stand-in for a model."""

    def make():
        import zlib

        def run(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dim), np.float32)
            for i, t in enumerate(texts):
                for w in t.lower().split():
                    h = zlib.crc32(w.encode())
                    out[i, h % dim] += 1 if h >> 16 & 1 else -1
            return out

        return run

    return make


def _blocks(vectors: DataFrame, rows: int, name: str) -> DataFrame:
    """Vectors in blocks of about ``rows``, one a row, with their ids."""
    n = max(1, -(-vectors.count() // rows))
    dealt = vectors.select("id", "vector", F.pmod(F.xxhash64("id"), F.lit(n)).alias("block"))
    return dealt.groupBy("block").agg(F.collect_list(F.struct("id", "vector")).alias("v")).select(F.col("v.id").alias(f"{name}_id"), F.col("v.vector").alias(f"{name}_vector"))


def nearest(queries: DataFrame, base: DataFrame, k: int, rows: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest cosine to each query, exact. Both sides have id and vector.

    Blocks of queries meet blocks of the base on the executors, and only each pair's k best go on; no vector is collected."""

    def unit(vectors) -> np.ndarray:
        x = np.array([np.asarray(v, np.float64) for v in vectors]).reshape(len(vectors), -1)
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for qi, q, vi, v in zip(b["q_id"], b["q_vector"], b["b_id"], b["b_vector"], strict=True):
                s, vi = np.round(unit(v) @ unit(q).T, 6), np.asarray(vi)
                for j in range(len(qi)):
                    top = np.lexsort((vi, -s[:, j]))[: k + 1]
                    yield pd.DataFrame({"query_id": qi[j], "vec_id": vi[top], "score": s[top, j]})

    met = _blocks(queries, rows, "q").crossJoin(_blocks(base, rows, "b"))
    cand = met.mapInPandas(run, "query_id long, vec_id long, score double").where("query_id <> vec_id")
    best = cand.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("b"))
    one = best.select("query_id", F.posexplode("b").alias("rank", "r"))
    return one.select("query_id", (F.col("rank") + 1).cast("long").alias("rank"), F.col("r.vec_id").alias("vec_id"), (-F.col("r.s")).alias("score"))


def hybrid(dense: Column, lexical: Column, alpha: float = 0.7) -> Column:
    return alpha * dense + (1 - alpha) * lexical
