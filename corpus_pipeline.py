"""documents -> quality rules -> near-duplicates -> repeated passages -> personal data -> packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import minhash_dedup, packing, quality_rules, suffix_dedup, surrogates
from millrace.llm._scratch import Scratch, released
from millrace.llm.resources import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.judge(docs, keep_only=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.keep_one(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_passages(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return surrogates.replace_entities(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("suffix_array_dedup", passage_dedup),
    ("pii", private_data),
    ("packing", packed),
]

#: Iterative joins, retrieval and tokenizers are out of SQL's reach; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next one; what a stage needed besides is deleted
    when it is written, and its input too."""
    scratch = Scratch(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        with released():
            docs = scratch.table(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
