"""Registered queries against their SQL."""

import glob
import os

import pytest

from weftlink.llm import queries

DATA = "/root/testdata/sf0.001"


def plain(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    return round(float(v), 6)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    got = queries.QUERIES[name](spark, DATA)
    cur = con.execute(queries.oracle_sql()[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == sorted(got.columns)
    order = [names.index(c) for c in got.columns]
    want = sorted(str([plain(r[i]) for i in order]) for r in cur.fetchall())
    assert sorted(str([plain(x) for x in r]) for r in got.collect()) == want
