"""Operator queries against their SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, digest_rows  # noqa: E402

from storyloom.llm import oracle, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_all_are_registered_with_the_pipeline():
    names = set(E.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {q.split("_")[0] + "_" for q in names}
    assert "pipeline" in names and set(oracle.SQL) <= set(queries.REGISTRY)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF)
    got = digest_rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(oracle.SQL[name])
    want = digest_rows([d[0] for d in res.description], res.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in res.description)
    assert got == want
