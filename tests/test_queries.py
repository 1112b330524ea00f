"""Every query with SQL gives the SQL's rows on the smallest tables."""

import os

import duckdb
import pytest

from millrace.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FAST = sorted(catalogue.oracle_sql())


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return "N" if v != v else repr(round(v, 6))
        if v is None:
            return "N"
        return str(list(v)) if isinstance(v, (list, tuple)) else str(v)

    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables")
@pytest.mark.parametrize("name", FAST)
def test_same_rows_as_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, DATA)
    cur = duck.execute(catalogue.oracle_sql()[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows([c[0] for c in cur.description], cur.fetchall())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables")
@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_runs(spark, name):
    assert catalogue.queries()[name](spark, DATA).count() > 0
