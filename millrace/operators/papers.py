"""Papers as a whole: where chunks and citations stand, statistics, totals, and repairs of titles and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .citations import citations, references
from .relational import keep_first, span_at
from .structure import headings

UNKNOWN = "Unknown"


def with_spans(docs: DataFrame, spans: DataFrame, key: str, name: str, fields: list[str]) -> DataFrame:
    """``docs`` with an array of their spans (start, end, fields) in order; empty where a document has none."""
    one = spans.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "end", *fields))).alias(name))
    kind = ", ".join(f"{f}: {spans.schema[f].dataType.simpleString()}" for f in fields)
    return docs.join(one, key, "left").withColumn(name, F.coalesce(name, F.array().cast(f"array<struct<start: bigint, end: bigint, {kind}>>")))


def section_at(sections: Column, position: Column) -> Column:
    """The section that holds a position; past the last one, that one; else Unknown."""
    return span_at(sections, position, "section", F.lit(UNKNOWN))


def page_at(pages: Column, position: Column) -> Column:
    """The page that holds a position; between or past pages the last one, without pages 1."""
    return F.coalesce(span_at(pages, position, "page", F.try_element_at(pages, F.lit(-1))["page"]), F.lit(1))


def annotated(chunks: DataFrame, sections: DataFrame, pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """chunks (key, chunk_index, char_start, char_end) with chunk_id and the sections and pages of both ends.

    sections: key, start, end, section; pages: key, start, end, page."""
    rows = with_spans(with_spans(chunks, sections, key, "_s", ["section"]), pages, key, "_p", ["page"])
    start, end = F.col("char_start"), F.col("char_end")
    return rows.select(
        *chunks.columns, F.concat(F.col(key).cast("string"), F.lit("_chunk_"), F.col("chunk_index").cast("string")).alias("chunk_id"),
        section_at(F.col("_s"), start).alias("section"), page_at(F.col("_p"), start).alias("page"), section_at(F.col("_s"), end).alias("section_end"), page_at(F.col("_p"), end).alias("page_end"),
    )


def located_citations(docs: DataFrame, sections: DataFrame, pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """Citations with section and page; those within a list of references, which only number its entries, are left out."""
    rows = with_spans(with_spans(citations(docs, key), sections, key, "_s", ["section"]), pages, key, "_p", ["page"])
    at = F.col("position")
    within = F.exists("_s", lambda s: F.lower(s["section"]).rlike("reference|bibliography") & (s["start"] <= at) & (at < s["end"]))
    hit = F.try_element_at(F.filter("_s", lambda s: (s["start"] <= at) & (at < s["end"])), F.lit(1))["section"]
    return rows.where(~within).select(key, "place", "mark", "position", "context", "numbers", F.coalesce(hit, F.lit(UNKNOWN)).alias("section"), page_at(F.col("_p"), at).alias("page"))


def statistics(docs: DataFrame, chunks: DataFrame, sections: DataFrame, pages: DataFrame, method: str, key: str = "doc_id") -> DataFrame:
    """Per document: num_chunks, num_pages, num_sections, total_chars, avg_chunk_size, chunking_method.

    Each part is summed up by itself before it meets the document."""
    c = chunks.groupBy(key).agg(F.count(F.lit(1)).alias("num_chunks"), F.avg(F.length("text")).alias("avg_chunk_size"))
    count = lambda df, name: df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    rows = docs.select(key, F.length("text").cast("long").alias("total_chars")).join(c, key, "left").join(count(pages, "num_pages"), key, "left").join(count(sections, "num_sections"), key, "left")
    whole = [F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in ("num_chunks", "num_pages", "num_sections", "total_chars")]
    return rows.select(key, *whole, F.coalesce("avg_chunk_size", F.lit(0.0)).alias("avg_chunk_size"), F.lit(method).alias("chunking_method"))


def batch_totals(results: DataFrame) -> DataFrame:
    """One row: total, successful, failed, skipped and rows with an error. results: status, error."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return results.agg(F.count(F.lit(1)).alias("total"), n("successful"), n("failed"), n("skipped"), F.count("error").alias("errors"))


def reference_summary(resolved: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document and kind of mention: total, resolved, unresolved; and the document's mentions per 1000 characters.

    resolved: mentions with their captions (null where there is none)."""
    kinds = resolved.groupBy(key, "kind").agg(F.count(F.lit(1)).alias("total"), F.count("caption").alias("resolved"))
    every = kinds.groupBy(key).agg(F.sum("total").alias("n"))
    dense = docs.select(key, F.length("text").alias("size")).join(every, key).select(key, F.when(F.col("size") > 0, F.round(F.col("n") / (F.col("size") / 1000), 2)).otherwise(0.0).alias("density"))
    return kinds.join(dense, key).select(key, "kind", "total", "resolved", (F.col("total") - F.col("resolved")).alias("unresolved"), "density")


def cited_enough(docs: DataFrame, least: int, key: str = "doc_id") -> DataFrame:
    """The documents that have at least ``least`` different citation marks."""
    n = citations(docs, key).groupBy(key).agg(F.countDistinct("mark").alias("_n"))
    return docs.join(n.where(F.col("_n") >= least).select(key), key, "left_semi") if least > 0 else docs


def title_and_author(title: Column, author: Column, first_page: Column) -> Column:
    """struct(title, author): exchanged where the title reads like a list of people and the author does not; missing ones are
    the first two lines of the first page that aren't blank."""
    people = lambda c: F.contains(F.lower(c), F.lit("and")) | F.contains(F.lower(c), F.lit("eds."))
    has = lambda c: F.coalesce(c, F.lit("")) != ""
    swap = has(title) & has(author) & people(title) & ~people(author)
    lines = F.filter(F.transform(F.split(F.coalesce(first_page, F.lit("")), "\n"), T.strip), lambda x: x != "")
    t, a = F.when(swap, author).otherwise(title), F.when(swap, title).otherwise(author)
    filled = lambda c, i: F.when(has(c), c).otherwise(F.coalesce(F.get(lines, F.lit(i)), F.lit("")))
    return F.struct(filled(t, 0).alias("title"), filled(a, 1).alias("author"))


def section_text(docs: DataFrame, number: str, key: str = "doc_id") -> DataFrame:
    """key, title, text: what stands under the heading of that number, up to the next heading."""
    h = headings(docs, key).where(F.col("number") == number).groupBy(key).agg(F.min_by(F.struct("line", "title", "next_line"), "line").alias("h"))
    rows = docs.select(key, F.split("text", "\n").alias("l")).join(h, key)
    end = F.coalesce(F.col("h.next_line"), F.size("l"))
    body = F.slice("l", F.col("h.line") + 2, F.greatest(end - F.col("h.line") - 1, F.lit(0)))
    return rows.select(key, F.col("h.title").alias("title"), T.strip(F.array_join(body, "\n")).alias("text"))


def references_of_any_format(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, ref_id, text of entries numbered ``[n]`` or ``n.``, or that begin with an author and have a year in brackets; an
    entry that several forms find is there once."""
    line = F.explode(F.filter(F.transform(F.split("text", "\n"), T.strip), lambda x: x != ""))
    rows = docs.select(key, line.alias("x"))
    dotted = rows.where(F.col("x").rlike(r"^[0-9]{1,3}\.[ \t]+[A-Z]")).select(key, F.regexp_extract("x", r"^([0-9]+)", 1).alias("ref_id"), F.regexp_replace("x", r"^[0-9]+\.[ \t]+", "").alias("text"))
    dated = rows.where(F.col("x").rlike(r"^[A-Z][A-Za-z\-]+,? .*\((?:19|20)[0-9]{2}[a-z]?\)")).select(key, F.lit(None).cast("string").alias("ref_id"), F.col("x").alias("text"))
    return references(docs, key).select(key, "ref_id", T.strip(F.col("text")).alias("text")).union(dotted).union(dated).groupBy(key, "text").agg(F.min("ref_id").alias("ref_id")).select(key, "ref_id", "text")


def first_by_title(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """The first of the rows (key, title, start_line and more) of one title, whatever its case; untitled ones all stay."""
    name = F.when(F.coalesce("title", F.lit("")) == "", F.col("start_line").cast("string")).otherwise(F.lower("title"))
    return keep_first(rows.withColumn("_t", name), [key, "_t"], ["start_line"]).select(*rows.columns)


def pages_of_cleaned(pages: Column, cleaned: Column) -> Column:
    """Pages with the lines of the cleaned text, each as many as it had; the last page takes the rest."""
    lines = F.split(cleaned, "\n")
    counts = F.transform(pages, lambda p: F.size(F.split(p["text"], "\n")))
    before = F.transform(counts, lambda _, i: F.aggregate(F.slice(counts, F.lit(1), i), F.lit(0), lambda a, x: a + x))
    last = F.size(pages) - 1

    def page(p: Column, i: Column) -> Column:
        n = F.when(i == last, F.lit(2**30)).otherwise(F.get(counts, i))
        text = F.array_join(F.slice(lines, F.get(before, i) + 1, n), "\n")
        return F.struct(p["page"].alias("page"), text.alias("text"), F.length(text).alias("char_count"))

    return F.transform(pages, page)


def without_voted_lines(parts: DataFrame, voted: DataFrame, key: str, edge: int = 3) -> DataFrame:
    """parts (key, part, text and more) without the lines among their first or last ``edge`` ones that were voted headers or
    footers. voted: key, line."""
    gone = voted.groupBy(key).agg(F.collect_set("line").alias("_gone"))
    rows = parts.join(gone, key, "left")
    lines = F.split("text", "\n")
    at_edge = lambda i: (i < edge) | (i >= F.size(lines) - edge)
    kept = F.filter(lines, lambda x, i: ~(at_edge(i) & F.coalesce(F.array_contains("_gone", T.strip(x)), F.lit(False))))
    return rows.withColumn("text", F.array_join(kept, "\n")).select(*parts.columns)
