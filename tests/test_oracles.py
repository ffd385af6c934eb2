"""Every registered query against its DuckDB oracle (the driver's check) on
the smallest driver tables; queries without an oracle must run and return
a stable schema."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, _rows  # noqa: E402

SF = os.environ.get("WORDLOOM_TEST_SF", "/root/testdata/sf0.001")
SLOW = {"word2vec_grid"}  # trains several models; its scores depend on the trainer


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.columns == ["lang", "term", "n", "rank"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(k for k in E.queries() if k not in SLOW))
def test_query_against_oracle(spark, duck, key):
    got = E.queries()[key](spark, SF).toPandas()
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert len(got.columns) > 0
        return
    want = duck.execute(sql).fetchdf()
    c1, r1 = _rows(got)
    c2, r2 = _rows(want)
    assert c1 == c2
    assert len(got) == len(want)
    assert r1 == r2
