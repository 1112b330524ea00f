"""Scores of extracted documents and chunks. Pages are an array of structs with text and char_count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T

EXPECTED = 2500  #: characters a page

# Words that tell of a document's parts.
PARTS = {
    "references": ("reference", "bibliography", "works cited", "literature"),
    "methods": ("method", "approach", "technique", "procedure"),
    "results": ("result", "experiment", "evaluation", "analysis", "findings"),
    "conclusion": ("conclusion", "summary", "discussion"),
    "figures": ("figure", "fig.", "fig "),
    "tables": ("table", "tab.", "tab "),
}
ACADEMIC = ("algorithm", "theorem", "proof", "lemma", "corollary", "proposition", "definition", "hypothesis", "dataset", "baseline")


def _ladder(*steps: tuple[Column, float], other: float) -> Column:
    out = F.lit(float(other))
    for cond, value in reversed(steps):
        out = F.when(cond, float(value)).otherwise(out)
    return out


def _clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def _any(text: Column, terms) -> Column:
    return text.rlike("|".join(t.replace(".", r"\.") for t in terms))


def _empty(pages: Column, under: int) -> Column:
    return F.size(F.filter(pages, lambda p: p["char_count"] < under))


def _total(pages: Column) -> Column:
    return F.aggregate(pages, F.lit(0).cast("long"), lambda a, p: a + p["char_count"])


def pdf_type(pages: Column, images: Column) -> Column:
    head = F.slice(pages, 1, 3)
    mean = _total(head) / F.greatest(F.size(head), F.lit(1))
    return F.when(F.size(head) == 0, "unknown").when(mean > 500, "text-based").when((mean < 100) & images, "scanned").otherwise("mixed")


def extraction_valid(text: Column, pages: Column, min_length: int = 1000) -> Column:
    """Whether a text looks like one: long enough, words of sensible length, sentences, few empty pages."""
    short = F.size(pages) <= 5
    least = F.when(short, F.greatest(F.lit(min_length / 2), F.lit(50.0))).otherwise(F.lit(float(min_length)))
    w = T.words(text)
    n = F.size(w)
    mean = F.aggregate(w, F.lit(0), lambda a, x: a + F.length(x)) / F.greatest(n, F.lit(1))
    long_ = F.size(F.filter(w, lambda x: F.length(x) > 15))
    solid = F.length(F.regexp_replace(text, r"[ \t\n\r\f]", ""))
    some = F.size(pages) <= 10
    return (
        (F.length(text) >= least) & (solid * 2 >= least) & (n >= min_length / 10) & (~some | (n >= min_length / 20))
        & ((F.size(T.sentences(text)) >= 2) | (short & (F.length(text) > 2 * min_length))) & (mean >= 1.5)
        & ~(some & (mean > 20) & (long_ * 10 > n * 3)) & (_empty(pages, 50) * 2 <= F.size(pages))
    )


def extraction_score(text: Column, pages: Column) -> Column:
    """0 to 1 from length, page coverage, structure and readability; weights differ for short documents."""
    n, p = F.length(text), F.size(pages)
    x, short = p * EXPECTED, p <= 10
    low = F.lower(text)
    length = _ladder((n < 500, 0.2), (n < 1000, 0.4), ((n < x * 0.3) & short, 0.75), (n < x * 0.3, 0.6), ((n < x * 0.6) & short, 0.9), (n < x * 0.6, 0.8), (n < x * 0.9, 0.9), (n > x * 2, 0.95), other=1.0)
    mean = _total(pages) / F.greatest(p, F.lit(1))
    thin = F.when(short, _ladder((mean < 200, 0.6), (mean < 500, 0.8), (mean < 1000, 0.9), (mean < 1500, 0.95), other=1.0)).otherwise(_ladder((mean < 200, 0.5), (mean < 500, 0.7), (mean < 1000, 0.85), other=1.0))
    coverage = (1 - 0.3 * _empty(pages, 50) / F.greatest(p, F.lit(1))) * thin
    coverage = F.when((p > 20) & (mean > 500), F.least(F.lit(1.0), coverage * 1.1)).otherwise(coverage)
    abstract = F.substring(low, 1, 3000).rlike(r"\b(?:abstract|summary|overview)\b")
    intro = F.substring(low, 1, 5000).rlike(r"\b(?:introduction|intro|background)\b")
    found = abstract.cast("int") + intro.cast("int") + sum((_any(low, t).cast("int") for t in PARTS.values()), F.lit(0))
    structure = F.least(F.lit(1.0), found / F.when(short & abstract, 4.0).otherwise(6.0))
    w = T.words(text)
    size = F.aggregate(w, F.lit(0), lambda a, v: a + F.length(v)) / F.greatest(F.size(w), F.lit(1))
    terms = sum((low.contains(t).cast("int") for t in ACADEMIC), F.lit(0))
    readable = (
        1.0 - F.when(F.regexp_count(text, F.lit(r"[ \t\n\r\f]+")) > 0.3 * n, 0.2).otherwise(0.0)
        - F.when(F.regexp_count(text, F.lit(r"\b[a-z][ \t\n\r\f]+[A-Z][a-z]")) * 1000 > n, 0.15).otherwise(0.0)
        - F.when((F.size(w) > 0) & (size < 2), 0.3).when((F.size(w) > 0) & (size > 15), 0.1).otherwise(0.0)
        - F.when(F.regexp_count(text, F.lit(r"[.!?]+[ \t\n\r\f]+")) < 4, 0.1).otherwise(0.0) + F.when(terms >= 3, 0.1).otherwise(0.0)
    )
    readable = _clamp(readable)
    score = F.when((n < 5000) | short, 0.2 * length + 0.2 * coverage + 0.35 * structure + 0.25 * readable).otherwise(0.3 * length + 0.3 * coverage + 0.2 * structure + 0.2 * readable)
    score = score + F.when(short & (structure >= 0.7) & (readable >= 0.8), 0.05).otherwise(0.0)
    return F.when((n == 0) | (p == 0), 0.0).otherwise(_clamp(score))


def improved_score(text: Column, pages: Column) -> Column:
    n, p, low = F.length(text), F.size(pages), F.lower(text)
    x = p * EXPECTED
    length = _ladder((n >= x * 0.8, 1.0), (n >= x * 0.6, 0.95), (n >= x * 0.4, 0.9), other=0.8)
    coverage = 1 - 0.2 * _empty(pages, 50) / F.greatest(p, F.lit(1))
    structure = F.least(F.lit(1.0), (low.contains("abstract").cast("int") + low.contains("introduction").cast("int") + low.contains("references").cast("int") + 0.5) / 3)
    return F.round(F.least(F.lit(1.0), 0.3 * length + 0.3 * coverage + 0.25 * structure + 0.135), 3)


def completeness(text: Column, pages: Column) -> Column:
    p, head, low = F.size(pages), F.substring(F.lower(text), 1, 5000), F.lower(text)
    coverage = 1 - 0.5 * _empty(pages, 100) / F.greatest(p, F.lit(1))
    got, x = _total(pages), p * EXPECTED
    density = F.least(F.lit(1.0), got / F.greatest(x, F.lit(1))) * _ladder((got < 0.3 * x, 0.8), (got < 0.6 * x, 0.9), other=1.0)
    need = head.contains("abstract").cast("int") + head.contains("introduction").cast("int")
    more = sum((low.contains(t).cast("int") for t in ("method", "result", "discussion", "conclusion", "reference")), F.lit(0))
    sections = F.when(need == 2, 0.7 + F.least(F.lit(0.3), more / 5)).otherwise(0.5 * need / 2)
    return 0.4 * coverage + 0.3 * density + 0.3 * sections


def coherence(text: Column) -> Column:
    s = T.sentences(text)
    mean = F.aggregate(s, F.lit(0), lambda a, x: a + F.length(x)) / F.greatest(F.size(s), F.lit(1))
    w = T.words(F.lower(text))
    broken = F.regexp_count(text, F.lit(r"\b[a-z] [A-Z][a-z]")) / F.greatest(F.size(w), F.lit(1))
    paras = F.filter(F.split(text, r"\n\n+"), lambda x: T.strip(x) != "")
    para = F.aggregate(paras, F.lit(0), lambda a, x: a + F.length(x)) / F.greatest(F.size(paras), F.lit(1))
    rich = F.size(F.array_distinct(w)) / F.greatest(F.size(w), F.lit(1))
    return (
        0.3 * _ladder((mean < 50, 0.6), (mean <= 200, 1.0), other=0.7) + 0.25 * _ladder((broken < 0.001, 1.0), (broken < 0.01, 0.8), (broken < 0.05, 0.5), other=0.2)
        + 0.25 * _ladder((F.size(paras) == 0, 0.5), (para < 200, 0.6), (para <= 1000, 1.0), other=0.7) + 0.2 * _ladder((rich > 0.3, 1.0), (rich > 0.2, 0.8), other=0.5)
    )


def structure(text: Column) -> Column:
    low = F.lower(text)
    groups = (("abstract",), ("introduction",), ("method",), ("result",), ("discussion",), ("conclusion",), ("references", "bibliography"))
    found = sum((_any(low, g).cast("int") for g in groups), F.lit(0))
    headings = F.regexp_count(text, F.lit(r"(?m)^[0-9]+(?:\.[0-9]+)*\.? +[A-Z]"))
    shown = F.regexp_count(low, F.lit(r"\b(?:figure|fig\.|table) *[0-9]+"))
    return 0.5 * found / 7 + 0.25 * F.least(F.lit(1.0), headings / 5) + 0.25 * F.least(F.lit(1.0), shown / 10)


def accuracy(text: Column) -> Column:
    n = F.greatest(F.length(text), F.lit(1))
    odd = F.regexp_count(text, F.lit(r"[^\p{L}\p{M}\p{N}_ \t\n\r.,;:!?'\"()\[\]\-]")) / n
    lost = F.regexp_count(text, F.lit("�")) / n
    gaps = (F.regexp_count(text, F.lit(" {3,}")) + F.regexp_count(text, F.lit(r"\n{4,}"))) * 1000 / n
    torn = F.regexp_count(text, F.lit(r"[A-Za-z]-\n[a-z]")) * 5000 / n
    return 0.25 * (
        _ladder((odd < 0.02, 1.0), (odd < 0.05, 0.8), (odd < 0.1, 0.5), other=0.2) + _ladder((lost < 0.001, 1.0), (lost < 0.01, 0.7), other=0.3)
        + _ladder((gaps < 1, 1.0), (gaps < 5, 0.7), other=0.4) + _ladder((torn < 0.5, 1.0), (torn < 2, 0.7), other=0.4)
    )


def metadata_score(title: Column, author: Column, page_count: Column, keywords: Column, subject: Column, creator: Column) -> Column:
    """Earned weight over the whole weight of 1."""
    has = lambda c, n: F.coalesce(F.length(c) >= n, F.lit(False)).cast("double")
    return 0.3 * has(title, 5) + 0.25 * has(author, 3) + 0.15 * F.coalesce(page_count > 0, F.lit(False)).cast("double") + 0.15 * has(keywords, 1) + 0.1 * has(subject, 5) + 0.05 * has(creator, 1)


def consistency(pages: Column) -> Column:
    """From the coefficient of variation of the pages' lengths (population)."""
    n = F.greatest(F.size(pages), F.lit(1))
    mean = _total(pages) / n
    var = F.aggregate(pages, F.lit(0.0), lambda a, p: a + (p["char_count"] - mean) * (p["char_count"] - mean)) / n
    cv = F.when(mean > 0, F.sqrt(var) / mean).otherwise(0.0)
    return F.when(F.size(pages) <= 1, 1.0).otherwise(_ladder((cv < 0.3, 1.0), (cv < 0.5, 0.8), (cv < 0.8, 0.6), other=0.4) * (1 - 0.5 * _empty(pages, 50) / n))


def enhanced_score(text: Column, pages: Column, meta: Column) -> Column:
    """A struct of all dimensions, the weighted total, and the issues."""
    dims = {"completeness": (completeness(text, pages), 0.25, 0.6), "coherence": (coherence(text), 0.2, 0.5), "structure": (structure(text), 0.2, 0.5), "accuracy": (accuracy(text), 0.15, 0.6), "metadata": (meta, 0.1, 0.5), "consistency": (consistency(pages), 0.1, 0.5)}
    total = sum((c * w for c, w, _ in dims.values()), F.lit(0.0))
    thin = _total(pages) / F.greatest(F.size(pages), F.lit(1)) < 500
    issues = F.array_compact(F.array(*[F.when(c < low, f"low_{k}") for k, (c, _, low) in dims.items()], F.when(thin, "thin_pages")))
    return F.struct(*[c.alias(k) for k, (c, _, _) in dims.items()], total.alias("total"), issues.alias("issues"), confidence(text, pages).alias("confidence"))


def confidence(text: Column, pages: Column) -> Column:
    n, p, s = F.length(text), F.size(pages), F.size(T.sentences(text))
    return (
        _ladder((n > 10000, 0.4), (n > 5000, 0.3), (n > 1000, 0.2), other=0.1) + _ladder((p > 20, 0.3), (p > 10, 0.2), (p > 5, 0.1), other=0.0)
        + _ladder((s > 100, 0.3), (s > 50, 0.2), (s > 20, 0.1), other=0.0)
    )


def document_score(n_text: Column, blank: Column, n_sections: Column, n_chunks: Column, avg_chunk: Column) -> Column:
    """10 less penalties, 0 at least."""
    cut = (
        F.when(n_text < 500, 2.0).when(n_text < 2000, 0.5).otherwise(0.0) + F.when(blank, 3.0).otherwise(0.0) + F.when(n_sections == 0, 0.5).when(n_sections < 3, 0.3).otherwise(0.0)
        + F.when(n_chunks == 0, 5.0).when(n_chunks < 5, 2.0).otherwise(0.0) + F.when(n_chunks == 0, 0.0).when(avg_chunk < 100, 1.0).when(avg_chunk > 2000, 0.3).otherwise(0.0)
    )
    return F.round(F.greatest(F.lit(0.0), 10.0 - cut), 2)


def score_band(score: Column) -> Column:
    return F.when(score >= 9, "excellent").when(score >= 7, "good").when(score >= 5, "fair").otherwise("poor")


def streaming_score(done: Column, total: Column, empty: Column) -> Column:
    coverage = done / F.greatest(total, F.lit(1))
    return F.when(coverage < 1, 0.7 * coverage).otherwise(1 - 0.3 * empty / F.greatest(done, F.lit(1)))


def threshold_issues(score: Column, mean_chars: Column, empty_ratio: Column) -> Column:
    return F.array_compact(F.array(F.when(score < 0.95, "low_score"), F.when(mean_chars < 1000, "low_density"), F.when(empty_ratio > 0.05, "empty_pages")))


def chunk_quality(text: Column) -> Column:
    """Coherence and accuracy of a chunk's text in equal parts."""
    return F.round(0.5 * coherence(text) + 0.5 * accuracy(text), 4)


def quality_report(score: Column, text: Column, pages: Column, least: float = 0.95, least_chars: int = 1000, most_empty: float = 0.05) -> Column:
    """struct of the checks of one extraction: score, length status, page coverage, and recommendations."""
    n = F.length(text)
    k = F.size(pages)
    mean = F.aggregate(pages, F.lit(0).cast("long"), lambda a, p: a + p["char_count"]) / F.greatest(k, F.lit(1))
    empty = F.size(F.filter(pages, lambda p: p["char_count"] < 50))
    some = k > 0
    advice = F.array_compact(F.array(F.when(score < least, "Consider re-extracting with different settings or OCR"), F.when(some & (mean < least_chars), "Check for figure-heavy pages or extraction issues")))
    return F.struct(
        score.alias("overall_score"), (score >= least).alias("score_passed"), n.cast("long").alias("length"), F.when(n > 10000, "good").when(n > 5000, "adequate").otherwise("low").alias("length_status"),
        F.when(some, F.round(mean)).alias("avg_chars_per_page"), F.when(some, empty).cast("long").alias("empty_pages"), F.when(some, (mean >= least_chars) & (empty / k <= most_empty)).alias("coverage_passed"), advice.alias("recommendations"),
    )
