"""Every query with SQL gives the same rows on another engine; every query runs and keeps its schema."""

import decimal
import glob
import math
import os

import duckdb
import pytest

from quellwerk.plans import roundtrips  # noqa: F401
from quellwerk.plans.queries import QUERIES, SQL


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v if v is None or isinstance(v, (bool, int)) else str(v)


@pytest.fixture(scope="session")
def duck(tiny):
    con = duckdb.connect()
    for f in glob.glob(f"{tiny}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, tiny, duck, name):
    df = QUERIES[name](spark, tiny)
    cols = sorted(df.columns)
    own = sorted(repr(tuple(norm(r[c]) for c in cols)) for r in df.collect())
    r = duck.execute(SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert own == sorted(repr(tuple(norm(x[i]) for i in order)) for x in r.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, tiny, name):
    df = QUERIES[name](spark, tiny)
    assert len(df.columns) == len(set(df.columns))
    df.write.format("noop").mode("overwrite").save()


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
