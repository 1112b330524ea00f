"""Chunkers: fixed windows, packed sentences, breaks by similarity, and repair of chunks that are too long."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import vectors as V

SIZE, OVERLAP, LEAST, MOST = 512, 50, 100, 1000
_STOP = re.compile(r"[.!?]\s+")


# --- fixed windows: sequential within a text, so an Arrow function ------------------------------------------------------


def fixed_spans(text: str, size: int = SIZE, overlap: int = OVERLAP, least: int = LEAST, most: int = MOST) -> list[tuple[int, int]]:
    """[start, end) of each window: it ends after the last sentence of its last 30 %, or else at white space, or else where
    it is full; without a stop at its end it may go on to the next sentence end within 200 characters."""
    out, start, n = [], 0, len(text)
    while start < n:
        full = min(start + size, n)
        end = full
        if full < n:
            from_ = max(start, full - int(size * 0.3))
            stops = [m.end() for m in _STOP.finditer(text, from_, full) if m.end() - start >= least]
            blank = max(text.rfind(" ", from_, full), text.rfind("\n", from_, full))
            end = stops[-1] if stops else blank + 1 if blank > start else full
            body = text[start:end].rstrip()
            if body and body[-1] not in ".!?;":
                ahead = _STOP.search(text, end, min(end + 200, n))
                if ahead and len(text[start : ahead.end()].rstrip()) <= most:
                    end = ahead.end()
        if len(text[start:end].strip()) >= least:
            out.append((start, end))
        if end >= n:
            break
        start = end - overlap if end - overlap > start else end
    return out


def fixed(docs: DataFrame, key: str = "doc_id", size: int = SIZE, overlap: int = OVERLAP, least: int = LEAST, most: int = MOST) -> DataFrame:
    """key, chunk_index, text, char_start, char_end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, rows = b.column(0), ([], [], [], [], [])
            for i, text in enumerate(b.column(1).to_pylist()):
                for k, (s, e) in enumerate(fixed_spans(text or "", size, overlap, least, most)):
                    for col, v in zip(rows, (i, k, text[s:e].strip(), s, e), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.string()), pa.array(rows[3], pa.int64()), pa.array(rows[4], pa.int64())], names=[key, "chunk_index", "text", "char_start", "char_end"])

    return docs.select(F.col(key).cast("long").alias(key), "text").mapInArrow(run, f"{key} long, chunk_index long, text string, char_start long, char_end long")


# --- packed sentences: a fold inside Catalyst ---------------------------------------------------------------------------


def packed(parts: Column, size: int, overlap: int = 0, joiner: str = " ") -> Column:
    """Greedy packing of an array of strings into chunks of ``size`` characters. With ``overlap``, a chunk begins with the
    last parts of the one before, as many as fit into it."""
    gap = len(joiner)
    text = F.array().cast("array<string>")
    state = F.struct(text.alias("done"), text.alias("cur"), F.lit(0).cast("int").alias("n"))

    def tail(cur: Column) -> Column:
        # parts from the end while what has been taken and the next one fit
        step = F.aggregate(
            F.reverse(cur), F.struct(text.alias("kept"), F.lit(0).alias("n"), F.lit(True).alias("open")),
            lambda a, s: F.when(a["open"] & (a["n"] + F.length(s) <= overlap), F.struct(F.concat(F.array(s), a["kept"]).alias("kept"), (a["n"] + F.length(s) + 1).alias("n"), F.lit(True).alias("open")))
            .otherwise(F.struct(a["kept"].alias("kept"), a["n"].alias("n"), F.lit(False).alias("open"))),
        )
        return F.struct(step["kept"].alias("cur"), step["n"].alias("n"))

    def add(a: Column, s: Column) -> Column:
        over = (F.size(a["cur"]) > 0) & (a["n"] + F.length(s) + (0 if overlap else gap - 1) > size)
        base = tail(a["cur"]) if overlap else F.struct(text.alias("cur"), F.lit(0).alias("n"))
        fresh = F.struct(F.concat(a["done"], F.array(F.array_join(a["cur"], joiner))).alias("done"), F.concat(base["cur"], F.array(s)).alias("cur"), (base["n"] + F.length(s) + gap).alias("n"))
        more = F.struct(a["done"].alias("done"), F.concat(a["cur"], F.array(s)).alias("cur"), (a["n"] + F.length(s) + gap).alias("n"))
        return F.when(over, fresh).otherwise(more)

    return F.aggregate(parts, state, add, lambda a: F.when(F.size(a["cur"]) > 0, F.concat(a["done"], F.array(F.array_join(a["cur"], joiner)))).otherwise(a["done"]))


def by_sentence(docs: DataFrame, key: str = "doc_id", size: int = SIZE, overlap: int = OVERLAP, least: int = LEAST) -> DataFrame:
    """key, chunk_index, text."""
    chunks = F.filter(packed(T.sentences(F.col("text")), size, overlap), lambda c: F.length(c) >= least)
    return docs.select(key, F.posexplode(chunks).alias("chunk_index", "text")).withColumn("chunk_index", F.col("chunk_index").cast("long"))


def split_long(text: Column, most: int = 1500) -> Column:
    """Short texts as they are. Else paragraphs are packed, and the last part, if too long, is packed again by sentence."""

    def of_parts(parts: Column) -> Column:
        last = F.element_at(parts, -1)
        cut = packed_by(F.split(F.regexp_replace(last, r"([.!?])[ \t\n\r\f]+", "$1␞"), "␞"), most, " ")
        return F.when(F.length(last) > most, F.concat(F.slice(parts, F.lit(1), F.size(parts) - 1), cut)).otherwise(parts)

    out = T.let(packed_paragraphs(F.split(text, "\n\n"), most), of_parts)
    return F.when(F.length(text) <= most, F.array(text)).otherwise(F.transform(out, T.strip))


def packed_by(parts: Column, most: int, joiner: str) -> Column:
    """Greedy packing where a chunk's length is that of its joined text."""
    gap = len(joiner)
    state = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))

    def add(a: Column, p: Column) -> Column:
        over = (a["cur"] != "") & (F.length(a["cur"]) + F.length(p) + gap > most)
        joined = F.when(a["cur"] == "", p).otherwise(F.concat(a["cur"], F.lit(joiner), p))
        return F.struct(F.when(over, F.concat(a["done"], F.array(a["cur"]))).otherwise(a["done"]).alias("done"), F.when(over, p).otherwise(joined).alias("cur"))

    return F.aggregate(parts, state, add, lambda a: F.concat(a["done"], F.array(a["cur"])))


def packed_paragraphs(parts: Column, most: int) -> Column:
    return packed_by(parts, most, "\n\n")


def parts_of_chunks(chunks: DataFrame, most: int = 1500) -> DataFrame:
    """chunks: doc_id, chunk_index, text. Long ones in parts numbered ``index.part``, with place, size and word count."""
    cut = chunks.withColumn("parts", split_long(F.col("text"), most))
    # outer: see T.let
    out = cut.select("doc_id", F.col("chunk_index").alias("original"), F.col("text").alias("whole"), F.size("parts").alias("total"), F.posexplode_outer("parts").alias("part", "text")).where("part is not null")
    split = F.col("total") > 1
    at = F.greatest(F.instr(F.col("whole"), F.substring("text", 1, 50)) - 1, F.lit(0))
    return out.select(
        "doc_id", F.when(split, F.concat_ws(".", F.col("original").cast("string"), F.col("part").cast("string"))).otherwise(F.col("original").cast("string")).alias("chunk_index"),
        "text", split.alias("is_split"), F.col("total").cast("long").alias("split_total"), at.cast("long").alias("char_start"), F.length("text").cast("long").alias("chunk_length"), F.size(T.words(F.col("text"))).cast("long").alias("word_count"),
    )


def citations_in_part(citations: Column, part: Column) -> Column:
    """The parent's citations that the part holds, or at least their first 20 characters."""
    return F.filter(citations, lambda c: F.contains(part, c) | F.contains(part, F.substring(c, 1, 20)))


# --- breaks by similarity -----------------------------------------------------------------------------------------------


def by_similarity(docs: DataFrame, key: str = "doc_id", most: int = MOST, least_similarity: float = 0.7, encoder=None, dim: int = 64) -> DataFrame:
    """Sentences of more than 10 characters; a chunk ends where it is full or the next sentence is unlike the last one. Each
    row is chunked by itself, beside its text: neither sentences nor vectors are rows."""
    s = docs.select(key, F.filter(T.sentences(F.col("text")), lambda x: F.length(x) > 10).alias("s"))
    s = s.withColumn("far", V.breaks(F.col("s"), encoder or V.hashing_encoder(dim), dim, least_similarity))
    rows = F.zip_with("s", "far", lambda x, y: F.struct(x.alias("s"), y.alias("far")))
    state = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))

    def add(a: Column, r: Column) -> Column:
        cut = (a["cur"] != "") & (r["far"] | (F.length(a["cur"]) + 1 + F.length(r["s"]) > most))
        joined = F.when(a["cur"] == "", r["s"]).otherwise(F.concat(a["cur"], F.lit(" "), r["s"]))
        return F.struct(F.when(cut, F.concat(a["done"], F.array(a["cur"]))).otherwise(a["done"]).alias("done"), F.when(cut, r["s"]).otherwise(joined).alias("cur"))

    chunks = F.when(F.size("s") > 0, F.aggregate(rows, state, add, lambda a: F.concat(a["done"], F.array(a["cur"]))))
    return s.select(key, F.posexplode(chunks).alias("chunk_index", "text")).withColumn("chunk_index", F.col("chunk_index").cast("long"))


def chunk(docs: DataFrame, method: str = "sentence", key: str = "doc_id", encoder=None, **how) -> DataFrame:
    """Dispatch by name. ``semantic`` without an encoder falls back to sentences."""
    if method == "semantic" and encoder is not None:
        return by_similarity(docs, key, encoder=encoder, **how)
    if method in ("sentence", "semantic"):
        return by_sentence(docs, key, **how)
    if method == "fixed":
        return fixed(docs, key, **how)
    raise ValueError(f"no chunker named {method}")


def fix_pipeline(chunks: DataFrame, most: int = 2000) -> DataFrame:
    """Short chunks go, tags and newlines are cleaned, a context header is put before the cleaned text, long ones are split."""
    t = F.col("text")
    kept = chunks.where(F.length(t) >= 50).withColumn("text", T.strip_html(t))
    kept = kept.withColumn("text", F.when(T.newline_dense(t), T.normalise_newlines(t)).otherwise(t))
    kept = kept.withColumn("text", T.context_header(t, F.col("title"), F.col("section")))
    return parts_of_chunks(kept, most)
