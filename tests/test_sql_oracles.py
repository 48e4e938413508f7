"""Every core query against its SQL on the same small tables."""

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb
import pytest
from mnemolake import queries as core


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 5)
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(core.all_queries()))
def test_query(spark, small, name):
    df = core.all_queries()[name](spark, small)
    columns = sorted(df.columns)
    rows = [tuple(norm(r[c]) for c in columns) for r in df.collect()]
    sql = core.all_sql().get(name)
    if sql is None:
        assert rows
        return
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{small}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    answer = con.execute(sql)
    names = [c[0] for c in answer.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert Counter(rows) == Counter(tuple(norm(r[i]) for i in at) for r in answer.fetchall())
