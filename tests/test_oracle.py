"""Every SQL-checked core query against DuckDB on the smallest tables."""

import math
import os

import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


def names():
    from quillwork.plans.registry import oracle_sql

    return sorted(oracle_sql())


@pytest.mark.parametrize("name", names())
def test_equals_duckdb(spark, duck, name):
    from quillwork.plans import registry

    got = registry.queries()[name](spark, DATA)
    cols = sorted(got.columns)
    rel = duck.execute(registry.oracle_sql()[name])
    theirs = [c[0] for c in rel.description]
    assert sorted(theirs) == cols
    a = sorted((tuple(canon(r[c]) for c in cols) for r in got.collect()), key=repr)
    b = sorted((tuple(canon(r[theirs.index(c)]) for c in cols) for r in rel.fetchall()), key=repr)
    assert a == b
