"""Every query by name, with its SQL."""

from __future__ import annotations

from . import chunks, corpus, embeddings, extraction, papers, relations, texts  # noqa: F401  they register their queries
from .registry import QUERIES, SQL, Query


def flagship(spark, sf_dir: str):
    return chunks.flagship(spark, sf_dir)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
