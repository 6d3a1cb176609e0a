"""Every contract query against its DuckDB oracle at sf0.001, plus the entry smoke."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from racelake import contract  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(contract.QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "gps_updated" in df.columns


def test_every_query_has_an_oracle():
    assert set(contract.ORACLE) == set(contract.QUERIES)
    assert set(contract.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    o_cols, o_rows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(s_cols, s_rows)[0] == digest(o_cols, o_rows)[0]
