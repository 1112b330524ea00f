"""Licences of files, with DataFrame functions only.

What a file says of its licence stands in a header or makes up a licence file. The lines and sentences of a text, its paragraphs
(line ends and comment signs joined), and the whole text of a licence file (LICENSE, COPYING, NOTICE ...) are compared with
templates, notices and whole licences, by the cosine of their sparse TF-IDF vectors. The weights come from the templates, so that
a file's licence never depends on other files; a word that the templates lack has the weight of the rarest one. A segment with a
cosine of THRESHOLD has one of a template's heaviest words, as all others together are too light, and its words of templates
weigh THRESHOLD of it at least, as the others are orthogonal to all templates; other segments are left out by these bounds.
Equal segments are scored once, and go from step to step by their hashes. A file has the licence of its best segment at THRESHOLD or more; "all rights
reserved" counts only beside no other licence. A file without one inherits from the nearest directory above it, its own
included, that has a licence file; of several licences in one directory the most frequent one, then the first by name. Ancestors
are resolved per directory, not per file, so that a directory with a third of all files costs one row before the last join,
which Spark can split.

Null and empty texts have no licence of their own, files with null paths inherit nothing, an empty table gives an empty result.
Texts of any length are read whole. Of equal scores the first licence by name counts. Repeated rows are repeated in the result.
Extra columns are kept out of the result but for those named in ``keys``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._scratch import Scratch
from .license_texts import TEMPLATES

THRESHOLD = 0.6
FILE = r"(?i)^(?:licen[cs]e|copying|notice|copyright)[^/]*$"
#: A word: letters and digits, and stops before digits.
WORD = r"[a-z0-9]+(?:\.[0-9][a-z0-9]*)*"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(f"({WORD})"))


def _weights() -> tuple[list[tuple[int, str, str, float]], dict[str, float], float]:
    """(template, licence, word, normalised weight), the weight of each word, that of unknown ones."""
    split = [re.findall(WORD, t.lower()) for _, t in TEMPLATES]
    df = {w: sum(w in s for s in split) for s in split for w in s}
    idf = {w: math.log(1 + len(split) / n) for w, n in df.items()}
    rows = []
    for i, ((name, _), s) in enumerate(zip(TEMPLATES, split, strict=True)):
        v = {w: s.count(w) * idf[w] for w in s}
        norm = math.sqrt(sum(x * x for x in v.values()))
        rows += [(i, name, w, x / norm) for w, x in v.items()]
    return rows, idf, math.log(1 + len(split))


def anchors() -> list[str]:
    """Words of which a segment has one at least if it is as near as THRESHOLD to any template: without a template's, what is
    left of it is shorter than THRESHOLD, and so is every product with it."""
    rows, out = _weights()[0], set()
    for i in range(len(TEMPLATES)):
        left = 1.0
        for w, x in sorted(((w, x) for k, _, w, x in rows if k == i), key=lambda r: (-r[1], r[0])):
            if left < 0.99 * THRESHOLD**2:
                break
            out.add(w)
            left -= x * x
    return sorted(out)


def near_some(found: Column) -> Column:
    """Whether words may be those of a segment as near as THRESHOLD to any template."""
    _, idf, rare = _weights()
    same: dict[float, list[str]] = {}
    for w, x in sorted(idf.items()):
        same.setdefault(x, []).append(w)

    def square(w: Column) -> Column:
        out = F.lit(rare**2)
        for x, of in sorted(same.items(), reverse=True):
            out = F.when(w.isin(*of), F.lit(x**2)).otherwise(out)
        return out

    # the squares of 1 + 1 + ... of a word add up as 1, 3, 5, ...
    start = F.struct(F.lit("").alias("w"), F.lit(1.0).alias("n"), F.lit(0.0).alias("s"))

    def add(weigh: Callable[[Column], Column]) -> Callable[[Column, Column], Column]:
        def one(a: Column, w: Column) -> Column:
            n = F.when(a["w"] == w, a["n"] + 2).otherwise(1.0)
            return F.struct(w.alias("w"), n.alias("n"), (a["s"] + n * weigh(w)).alias("s"))

        return one

    def squares(of: Column, weigh: Callable[[Column], Column]) -> Column:
        return F.aggregate(F.array_sort(of), start, add(weigh), lambda a: a["s"])

    # each of the others once, then as often as it comes
    least = lambda known: F.lit(rare**2) * (F.size(found) - F.size(known))
    exact = lambda: squares(F.filter(found, lambda w: ~w.isin(*idf)), lambda w: F.lit(rare**2))
    enough = lambda ours, rest: ours >= 0.99 * THRESHOLD**2 * (ours + rest)
    anchored = F.arrays_overlap(found, F.array(*map(F.lit, anchors())))
    ours = lambda known: F.array(F.struct(squares(known, square).alias("ours"), least(known).alias("least")))
    near = lambda x: enough(x["ours"], x["least"]) & anchored & enough(x["ours"], exact())
    return F.exists(F.array(F.filter(found, lambda w: w.isin(*idf))), lambda known: F.exists(ours(known), near))


def segments(text: Column, whole: Column) -> Column:
    """The lines, sentences and paragraphs of a text, and all of it if ``whole``, each once, that may be near a template."""
    flat = lambda t: F.regexp_replace(t, r"\s*\n[ \t]*(?:[#*;%]+|//+|--+)?[ \t]*", " ")
    paragraphs = F.transform(F.split(text, r"\n[ \t#*;%/\-]*\n"), flat)
    every = F.concat(F.split(text, r"\n|[.!?] +"), paragraphs, F.when(whole, F.array(flat(text))).otherwise(F.array().cast("array<string>")))
    return F.array_distinct(F.filter(every, lambda s: F.exists(F.array(words(s)), near_some)))


def score_segments(found: DataFrame) -> DataFrame:
    """found: distinct ``segment``. Adds licence and score of the template nearest to each; none under THRESHOLD."""
    rows, idf, rare = _weights()
    spark = found.sparkSession
    table = F.broadcast(spark.createDataFrame(rows, "template int, license string, word string, w double"))  # the templates: fixed
    known = F.broadcast(spark.createDataFrame(list(idf.items()), "word string, idf double"))
    known_as = found.select(F.unhex(F.sha2("segment", 256)).alias("h"), "segment").repartition("h")  # the only shuffle of a segment
    tf = known_as.select("h", F.explode(words(F.col("segment"))).alias("word")).groupBy("h", "word").agg(F.count(F.lit(1)).alias("tf"))
    v = tf.join(known, "word", "left").withColumn("v", F.col("tf") * F.coalesce("idf", F.lit(rare)))
    norm = v.groupBy("h").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    dot = v.join(table, "word").groupBy("h", "template", "license").agg(F.sum(F.col("v") * F.col("w")).alias("dot"))
    cos = dot.join(norm, "h").withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("score") >= THRESHOLD)
    best = cos.groupBy("h").agg(F.min(F.struct((F.col("license") == "proprietary").alias("p"), (-F.col("score")).alias("s"), F.col("license"))).alias("b"))
    return known_as.join(best, "h").select("segment", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"))


def directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def named(path: Column) -> Column:
    """Whether a path is that of a licence file."""
    return F.coalesce(F.element_at(F.split(path, "/"), -1).rlike(FILE), F.lit(False))


def scan(files: DataFrame, keys: list[str]) -> DataFrame:
    """files: path, text and the columns ``keys``. Per row: keys, path, license, score, origin (own, inherited or null) and
    license_dir (of an inherited one)."""
    scratch = Scratch(files.sparkSession)
    slim = scratch.table(files.select(*keys, "path", segments(F.col("text"), named(F.col("path"))).alias("seg")))
    has = slim.where("size(seg) > 0")
    scored = score_segments(has.select(F.explode("seg").alias("segment")).distinct()).select(F.unhex(F.sha2("segment", 256)).alias("of"), "license", "score")
    rows = has.select("path", F.xxhash64("seg").alias("h"), F.explode(F.transform("seg", lambda s: F.unhex(F.sha2(s, 256)))).alias("of")).distinct()
    first = F.min(F.struct((F.col("license") == "proprietary").alias("p"), (-F.col("score")).alias("s"), F.col("license").alias("l"))).alias("b")
    own = rows.join(scored, "of").groupBy("path", "h").agg(first)
    own = own.select(F.col("path").alias("_p"), "h", F.col("b.l").alias("license"), (-F.col("b.s")).alias("score"))
    with_own = slim.withColumn("h", F.when(F.size("seg") > 0, F.xxhash64("seg"))).alias("f").join(own.alias("o"), F.expr("f.path <=> o._p and f.h = o.h"), "left")
    with_own = scratch.table(with_own.select(*[f"f.{k}" for k in keys], "f.path", "license", "score"))
    given = with_own.where(F.col("license").isNotNull() & named(F.col("path"))).groupBy(directory(F.col("path")).alias("dir"), "license").agg(F.count(F.lit(1)).alias("n"))
    given = given.groupBy("dir").agg(F.min(F.struct((-F.col("n")).alias("n"), "license")).alias("b")).select("dir", F.col("b.license").alias("license"))
    dirs = with_own.where("path is not null and license is null").select(directory(F.col("path")).alias("of")).distinct()
    parts = F.split("of", "/")
    above = dirs.withColumn("depth", F.explode(F.sequence(F.lit(0), F.size(parts)))).select("of", "depth", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/").alias("dir"))
    nearest = above.join(given, "dir").groupBy("of").agg(F.max(F.struct("depth", "dir", "license")).alias("b")).select("of", F.col("b.dir").alias("license_dir"), F.col("b.license").alias("got"))
    bare = with_own.withColumn("of", F.when(F.col("license").isNull(), directory(F.col("path"))))
    out = bare.join(nearest, "of", "left")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("got").isNotNull(), "inherited")
    return out.select(*keys, "path", F.coalesce("license", "got").alias("license"), "score", origin.alias("origin"), F.when(F.col("license").isNull(), F.col("license_dir")).alias("license_dir"))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files: source/lang/doc_id.txt; a text whose first line speaks of a licence is source/lang/LICENSE-doc_id."""
    first = F.substring_index(F.coalesce("text", F.lit("")), "\n", 1)
    lic = first.rlike("[Ll]icen[cs]e|[Cc]opyright")
    name = F.concat(F.when(lic, F.lit("LICENSE-")).otherwise(""), F.col("doc_id").cast("string"), F.when(lic, "").otherwise(".txt"))
    return docs.select("doc_id", F.concat_ws("/", "source", "lang", name).alias("path"), "text")
