"""Registered queries that SQL can express, against their SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as E
from tagloom.llm.oracle import ORACLE
from tagloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = E.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert "pipeline" in names and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted((tuple(r[cols.index(c)] for c in df.columns) for r in res.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.collect()), key=repr) == want
