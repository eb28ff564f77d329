"""Every registered query against its SQL on the smallest tables."""

import datetime
import glob
import os

import duckdb
import pytest

import __spark_entry__
from refinery.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    if isinstance(v, datetime.datetime):
        return str(v.date()) if v.time() == datetime.time() else str(v)
    return str(v)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    cur = duck.execute(catalogue.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in sorted(cols)) for r in df.collect())
    want = sorted(tuple(plain(r[cols.index(c)]) for c in sorted(cols)) for r in cur.fetchall())
    assert got == want


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["category_id", "ingredient_name", "usage_count", "rank"]
    assert df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
