"""Corpus reports: one pass of conditional aggregates each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def stats(c: Column, prefix: str = "") -> list[Column]:
    d = c.cast("double")
    return [F.count(c).alias(f"{prefix}n"), F.round(F.avg(d), 4).alias(f"{prefix}mean"), F.round(F.median(d), 4).alias(f"{prefix}median"), F.round(F.stddev_samp(d), 4).alias(f"{prefix}stdev"), F.min(d).alias(f"{prefix}min"), F.max(d).alias(f"{prefix}max")]


def by_group(df: DataFrame, group: str, value: Column) -> DataFrame:
    return df.groupBy(group).agg(*stats(value))


def size_bands(df: DataFrame, n: Column) -> DataFrame:
    counted = df.groupBy(T.size_band(n).alias("band")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("total"))
    return counted.crossJoin(total).select("band", "n", F.round(100.0 * F.col("n") / F.col("total"), 4).alias("pct"))


def chunk_report(chunks: DataFrame) -> DataFrame:
    """chunks: text, quality, section, keywords. Empty, short and long exclude each other."""
    n = F.length("text")
    has = lambda c: F.count_if(F.coalesce(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.lit(False)))
    q = F.col("quality").cast("double")
    return chunks.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(T.strip(F.col("text")) == "").alias("empty"), F.count_if((T.strip(F.col("text")) != "") & (n < 50)).alias("short"), F.count_if(n > 2000).alias("long"),
        F.round(F.avg(n), 4).alias("avg_size"), F.median(n).cast("double").alias("median_size"), F.min(n).cast("long").alias("min_size"), F.max(n).cast("long").alias("max_size"),
        F.round(F.avg(q), 3).alias("avg_quality"), F.min(q).alias("min_quality"), F.max(q).alias("max_quality"), F.count_if(q < 0.7).alias("low_quality"),
        has("section").alias("with_section"), has("quality").alias("with_quality"), F.count_if(T.has_header(F.col("text"))).alias("with_header"),
    )


def embedding_readiness(chunks: DataFrame) -> DataFrame:
    t, n = F.col("text"), F.length("text")
    return chunks.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(n < 50).alias("too_short"), F.count_if(n > 2000).alias("too_long"), F.count_if((n >= 200) & (n <= 1500)).alias("optimal"),
        F.count_if(T.token_estimate(t) > 8192).alias("over_token_limit"), F.count_if(T.strip(t) == "").alias("empty"), F.count_if(t.rlike(r"^[^A-Za-z0-9\x80-\x{10FFFF}]+$")).alias("special_only"),
        F.count_if(t.contains("�")).alias("bad_encoding"), F.count_if(t.rlike("<[^>]+>")).alias("with_html"), F.count_if(t.rlike(r"^[$\\]+")).alias("latex_start"), F.count_if(T.newline_dense(t)).alias("newline_dense"),
        F.count_if(t.contains(" " * 20)).alias("space_run"), F.count_if(t.rlike("^https?://")).alias("url_start"), F.count_if(~T.has_header(t)).alias("no_header"),
    )


def verdict(issues: Column, total: Column) -> Column:
    return F.when(issues == 0, "ready").when(issues * 100 < total, "nearly_ready").when(issues * 20 < total, "needs_minor_fixes").otherwise("needs_work")


def coverage(df: DataFrame, fields: list[str]) -> DataFrame:
    """field, n, pct: how many rows have each field, null and empty counting as missing."""
    filled = [F.count_if(F.coalesce(F.col(c).cast("string") != "", F.lit(False))).alias(c) for c in fields]
    one = df.agg(F.count(F.lit(1)).alias("_total"), *filled)
    return one.select("_total", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("n")) for c in fields])).alias("f")).select("f.field", "f.n", F.round(100.0 * F.col("f.n") / F.greatest("_total", F.lit(1)), 4).alias("pct"))


def key_frequency(df: DataFrame, maps: Column) -> DataFrame:
    return df.select(F.explode(F.map_keys(maps)).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def missing_keys(df: DataFrame, maps: Column, required: list[str]) -> DataFrame:
    one = df.agg(*[F.count_if(~F.coalesce(F.map_contains_key(maps, k), F.lit(False))).alias(k) for k in required])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("n_missing")) for k in required])).alias("k")).select("k.*")


def improvements(docs: DataFrame, seconds: Column, chars: Column, quality: Column) -> DataFrame:
    """rule, n: slow (over twice the mean), thin (under half the mean), low quality, and so on."""
    base = docs.agg(F.avg(seconds).alias("ms"), F.avg(chars).alias("mc"))
    j = docs.crossJoin(F.broadcast(base))  # one row
    rules = {"slow": seconds > 2 * F.col("ms"), "thin": chars < 0.5 * F.col("mc"), "low_quality": quality < 0.9, "very_low_quality": quality < 0.7, "empty": chars == 0}
    one = j.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in rules.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("n")) for k in rules])).alias("r")).select("r.*").where("n > 0")


def keyword_fallback(docs: DataFrame, key: str = "doc_id", k: int = 10) -> DataFrame:
    """key, rank, word, n: the most frequent words of four letters or more that make up less than 5 % of a text; of equally
    frequent ones the earlier. Texts of one key count together.

    Texts are dealt out and sorted by key once and their words counted beside them, so words are never written anywhere."""

    def best(texts: list[pa.Array]) -> tuple[list[str], list[int]]:
        words = (pa.concat_arrays(texts) if len(texts) > 1 else texts[0]).dictionary_encode()
        names, at = words.dictionary, words.indices.to_numpy()
        n, first = np.bincount(at, minlength=len(names)), np.full(len(names), len(at))
        np.minimum.at(first, at, np.concatenate([np.arange(len(t)) for t in texts]))
        fit = np.flatnonzero((n < 0.05 * len(texts[0])) & (pc.utf8_length(names).to_numpy() >= 4))
        tie = np.zeros(len(fit), np.int64)
        if len(texts) > 1:  # words of different texts may stand in one place
            tie[sorted(range(len(fit)), key=lambda i: names[int(fit[i])].as_py().encode())] = np.arange(len(fit))
        top = fit[np.lexsort((tie, first[fit], -n[fit]))[:k]]
        return names.take(pa.array(top)).to_pylist(), n[top].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(keys: pa.Array, groups: list[list[pa.Array]]) -> pa.RecordBatch:
            found = [best(g) for g in groups]
            size = [len(w) for w, _ in found]
            at = np.repeat(np.arange(len(found)), size)
            rank = np.concatenate([np.arange(1, m + 1) for m in size]) if size else np.zeros(0, np.int64)
            words, n = [x for w, _ in found for x in w], [x for _, c in found for x in c]
            return pa.RecordBatch.from_arrays([keys.take(pa.array(at, pa.int64())), pa.array(rank, pa.int64()), pa.array(words, pa.string()), pa.array(n, pa.int64())], names=[key, "rank", "word", "n"])

        last, kept = None, []  # the last key may go on in the next batch
        for b in batches:
            keys, w = b.column(0), b.column(1)
            at, values, same = w.offsets.to_numpy(), w.values, keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]])) if len(b) else []
            groups = [[values.slice(at[i], at[i + 1] - at[i]) for i in range(s, e)] for s, e in zip(starts, [*starts[1:], len(b)], strict=True)]
            if groups and last is not None:
                if last[0].as_py() == keys[0].as_py():
                    groups[0] = kept + groups[0]
                else:
                    yield table(last, [kept])
            if groups:
                yield table(keys.take(pa.array(starts[:-1], pa.int64())), groups[:-1])
                last, kept = keys.slice(int(starts[-1]), 1), groups[-1]
        if last is not None:
            yield table(last, [kept])

    words = F.regexp_extract_all(F.lower("text"), F.lit(f"({T.WORD})"), F.lit(1))
    rows = docs.select(key, "text").where(F.col("text").isNotNull()).repartition(key).sortWithinPartitions(key).select(key, words.alias("w"))
    return rows.mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, rank long, word string, n long")
