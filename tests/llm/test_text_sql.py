"""The text queries that SQL can say, against their SQL."""

import glob
import os
from collections import Counter

import duckdb
import pytest
from mnemolake.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.all_sql()))
def test_query(spark, small, name):
    rows = [tuple(sorted(r.asDict().items())) for r in Q.all_queries()[name](spark, small).collect()]
    con = duckdb.connect()
    for f in glob.glob(f"{small}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    answer = con.execute(Q.all_sql()[name])
    names = [c[0] for c in answer.description]
    assert rows and Counter(rows) == Counter(tuple(sorted(zip(names, r))) for r in answer.fetchall())
