"""Sources: document stores, JSON corpora, id lists, tracking logs, sidecars, embeddings and page extractors."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T


def files(spark: SparkSession, root: str, pattern: str = "*.pdf", content: bool = False) -> DataFrame:
    """category, year_month, name, path, size, mtime of files at category/year_month/name; resource forks and empty files
    are left out. Bytes are read only if asked for."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    out = df.where(~F.startswith(name, F.lit("._")) & (F.col("length") > 0) & (F.size(parts) >= 3))
    cols = [F.element_at(parts, -3).alias("category"), F.element_at(parts, -2).alias("year_month"), name.alias("name"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime")]
    return out.select(*cols, *(["content"] if content else []))


def id_list(spark: SparkSession, path: str, categories: list[str]) -> DataFrame:
    """category, paper_id from lines ``category|id``; a bare id stands for every category. Bad lines are left out."""
    return parse_ids(spark.read.text(path), categories)


def parse_ids(lines: DataFrame, categories: list[str]) -> DataFrame:
    v = T.strip(F.col("value"))
    both = F.split(v, r"\|", 2)
    rows = lines.select(F.when(v.contains("|"), F.array(both[0])).otherwise(F.array(*map(F.lit, categories))).alias("cats"), F.when(v.contains("|"), F.try_element_at(both, F.lit(2))).otherwise(v).alias("paper_id"))
    return rows.where("paper_id <> ''").select(F.explode("cats").alias("category"), "paper_id").where(F.col("category").isin(categories))


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Tracking rows; malformed lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def json_corpus(spark: SparkSession, root: str, schema: StructType, recursive: bool = True) -> DataFrame:
    """One document per file, with file and error (of files that can't be parsed)."""
    full = StructType([*schema.fields]).add("_corrupt_record", "string")
    df = spark.read.schema(full).option("multiLine", True).option("recursiveFileLookup", recursive).option("mode", "PERMISSIVE").option("pathGlobFilter", "*.json").json(root)
    return df.withColumn("file", F.col("_metadata.file_name")).where(~F.startswith("file", F.lit("._"))).withColumnRenamed("_corrupt_record", "error")


def chunks_of(papers: DataFrame, least: float = 0.0, missing: float = 0.0) -> DataFrame:
    """Chunks, one row each, of a quality of ``least`` or more; ``missing`` stands in for no score."""
    c = papers.select("paper_id", F.posexplode("chunks").alias("place", "c")).select("paper_id", "place", "c.*")
    return c.where(F.coalesce(F.col("metadata.quality_score"), F.lit(missing)) >= least)


def sidecar(text: DataFrame) -> DataFrame:
    """value: whole ``key: value`` files. Adds meta, a map with lower-case keys; later lines win."""
    rows = F.filter(F.transform(F.split("value", "\n"), lambda x: F.struct(F.lower(T.strip(F.element_at(F.split(x, ":", 2), 1))).alias("k"), T.strip(F.try_element_at(F.split(x, ":", 2), F.lit(2))).alias("v"))), lambda r: r["v"].isNotNull() & (r["k"] != ""))
    keys = F.array_distinct(F.transform(rows, lambda r: r["k"]))
    return text.withColumn("meta", F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(rows, lambda r: r["k"] == k), -1)["v"])))


def embeddings(spark: SparkSession, path: str, batch: int | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if batch is None else df.where(F.col("batch_index") == batch)


#: name -> function from bytes to {"text", "pages"}; ``html`` is here, others may be added by their libraries' users
EXTRACTORS: dict[str, Callable[[bytes], dict]] = {}


def extractor(name: str):
    def add(f: Callable[[bytes], dict]) -> Callable[[bytes], dict]:
        EXTRACTORS[name] = f
        return f

    return add


@extractor("text")
def _plain(raw: bytes) -> dict:
    pages = raw.decode("utf-8", "replace").split("\f")
    return {"text": "\n\n".join(pages), "pages": pages}


@extractor("html")
def _html(raw: bytes) -> dict:
    import html
    import re

    body = re.sub(r"(?is)<(script|style)\b.*?</\1>", " ", raw.decode("utf-8", "replace"))
    text = re.sub(r"[ \t]+", " ", html.unescape(re.sub(r"<[^>]+>", " ", body))).strip()
    return {"text": text, "pages": [text]}


RESULT = "path string, success boolean, method string, error string, text string, pages array<struct<page:int,text:string,char_count:int>>"


def extract(raw: DataFrame, methods: tuple[str, ...] = ("html", "text")) -> DataFrame:
    """raw: path, content. The first method that gives text wins; failures are rows with their error."""
    tools = {m: EXTRACTORS[m] for m in methods}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path, content in zip(b["path"], b["content"], strict=True):
                row = {"path": path, "success": False, "method": None, "error": None, "text": "", "pages": []}
                for m, f in tools.items():
                    try:
                        got = f(bytes(content))
                    except Exception as e:  # the next method may read it
                        row["error"] = f"{m}: {e}"
                        continue
                    if got["text"].strip():
                        row |= {"success": True, "method": m, "error": None, "text": got["text"], "pages": [{"page": i + 1, "text": p, "char_count": len(p)} for i, p in enumerate(got["pages"])]}
                        break
                out.append(row)
            yield pd.DataFrame(out, columns=["path", "success", "method", "error", "text", "pages"])

    return raw.select("path", "content").mapInPandas(run, RESULT)


def first_version(attempts: DataFrame) -> DataFrame:
    """attempts: paper_id, version, ok, path. The lowest version that could be fetched."""
    return attempts.where("ok").groupBy("paper_id").agg(F.min("version").alias("version"), F.min_by("path", "version").alias("path"))


def resume_state(path: str) -> dict:
    with open(path) as f:
        return json.load(f)
