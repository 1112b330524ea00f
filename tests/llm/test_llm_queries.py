"""Queries of the subpackage against their SQL, and all of them run."""

import os

import pytest

from millrace.llm import oracles, queries

from ..test_queries import DATA, duck, rows  # noqa: F401


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables")
@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):  # noqa: F811
    df = queries.queries()[name](spark, DATA)
    cur = duck.execute(oracles.oracle_sql()[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows([c[0] for c in cur.description], cur.fetchall())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables")
@pytest.mark.parametrize("name", ["op2_license_scan", "op3_toxicity", "op8_image_copies"])
def test_runs(spark, name):
    assert queries.queries()[name](spark, DATA).count() > 0
