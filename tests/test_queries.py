import math

import duckdb
import pytest

from tidemark.queries import oracle_sql, queries

DATA = "/root/testdata/sf0.001"
TABLES = ("events", "lineitem", "orders")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    value = lambda v: "" if v is None or isinstance(v, float) and math.isnan(v) else repr(v + 0.0) if isinstance(v, float) else str(v)
    return sorted(columns), sorted(tuple(value(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, DATA)
    got = canonical(df.collect(), df.columns)
    want = duck.sql(oracle_sql()[name])
    assert got == canonical(want.fetchall(), want.columns)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())
