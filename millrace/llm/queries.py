"""One query per operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import image_copies, license_scan, minhash_dedup, packing, quality_rules, sentencepiece_codec, suffix_dedup, surrogates, toxicity, url_filter
from .resources import tokenizer_path


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_documents(spark, sf_dir))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(license_scan.document_files(_documents(spark, sf_dir)), ["doc_id"])


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held)
    model = toxicity.fit(docs, labels.select("doc_id", "toxic"))
    out = toxicity.score(docs, model)
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(_documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its entities replaced, and how many there were of each type."""
    out = surrogates.replace_entities(_documents(spark, sf_dir), count="n")
    counts = [F.coalesce(F.try_element_at("n", F.lit(k)), F.lit(0)).cast("long").alias(f"n_{k}") for k in surrogates.PATTERNS]
    return out.select("doc_id", "text", "lang", "source", "n_chars", *counts)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json")).drop("ids")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.passages(_documents(spark, sf_dir))


def op8_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings as images, one for each row."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    return image_copies.copies(image_copies.rendered(vectors)).withColumnRenamed("id", "vec_id")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return url_filter.judge(pages, url_filter.junk_titled(pages))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(_documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir).drop("ids")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
    return own | {"pipeline": pipeline}
