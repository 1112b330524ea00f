"""Identifiers in texts: DOIs, preprint numbers, URLs, e-mail addresses, ISBNs and ORCIDs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DOI = r"10\.[0-9]{4,9}/[A-Za-z0-9._;()/:\-]+"
ARXIV = r"(?:arXiv:)([0-9]{4}\.[0-9]{4,5}(?:v[0-9]+)?|[a-z\-]+/[0-9]{7})"
URL = r"(?:https?|ftp)://[^ \t\n\r<>\"{}|\\^`\[\]]+"
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
ISBN = r"ISBN(?:-1[03])?:? *([0-9][0-9\-]{8,15}[0-9Xx])"
ORCID = r"[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X]"


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))


def dois(text: Column) -> Column:
    return F.array_distinct(F.transform(_all(text, DOI), lambda d: F.regexp_replace(d, r"[.,;:)]+$", "")))


def doi_valid(doi: Column) -> Column:
    return doi.rlike(r"^10\.[0-9]{4,9}/[^ ]+$") & (F.length(doi) >= 8)


def arxiv_ids(text: Column) -> Column:
    return _all(text, ARXIV, 1)


def arxiv_kind(i: Column) -> Column:
    return F.when(i.rlike(r"^[0-9]{4}\.[0-9]{4,5}v[0-9]+$"), "new_versioned").when(i.rlike(r"^[0-9]{4}\.[0-9]{4,5}$"), "new").when(i.rlike(r"^[a-z\-]+/[0-9]{7}$"), "old").otherwise("unknown")


def arxiv_year(i: Column) -> Column:
    """Numbers begin with year and month of two digits each; the old ones after the slash."""
    yy = F.regexp_extract(i, r"^(?:[a-z\-]+/)?([0-9]{2})", 1)
    return F.when(yy == "", None).otherwise(F.when(i.contains("/") & (yy > "90"), 1900).otherwise(2000) + yy.try_cast("int"))


def urls(text: Column) -> Column:
    return F.transform(_all(text, URL), lambda u: F.regexp_replace(u, "[.,;]+$", ""))


def url_type(url: Column) -> Column:
    low = F.lower(url)
    return (
        F.when(low.contains("arxiv.org"), "arxiv").when(low.contains("doi.org"), "doi").when(low.contains("github.com"), "github").when(low.rlike(r"\.pdf([?#]|$)"), "pdf")
        .when(low.rlike("ieee|acm\\.org|springer|sciencedirect|nature\\.com"), "journal").otherwise("general")
    )


def emails(text: Column) -> Column:
    return _all(text, EMAIL)


def isbns(text: Column) -> Column:
    return F.array_distinct(F.transform(_all(text, ISBN, 1), lambda i: F.regexp_replace(i, "-", "")))


def isbn_type(isbn: Column) -> Column:
    return F.when(F.length(isbn) == 13, "ISBN-13").when(F.length(isbn) == 10, "ISBN-10").otherwise("unknown")


def orcids(text: Column) -> Column:
    return _all(text, ORCID)


def orcid_valid(orcid: Column) -> Column:
    """The check digit of ISO 7064 mod 11-2, X for ten."""
    digits = F.transform(F.sequence(F.lit(1), F.lit(15)), lambda i: F.substring(F.replace(orcid, F.lit("-"), F.lit("")), i, F.lit(1)).try_cast("int"))
    total = F.aggregate(digits, F.lit(0), lambda a, d: (a + d) * 2)
    check = (12 - total % 11) % 11
    return F.when(check == 10, "X").otherwise(check.cast("string")) == F.substring(orcid, -1, 1)


def identifiers(text: Column) -> Column:
    return F.struct(dois(text).alias("dois"), arxiv_ids(text).alias("arxiv_ids"), urls(text).alias("urls"), emails(text).alias("emails"), isbns(text).alias("isbns"), orcids(text).alias("orcids"))
