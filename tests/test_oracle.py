"""Every registered query against its DuckDB oracle on the smallest tables."""
import os

import duckdb
import pytest

import __spark_entry__ as entry
from ebbflow.plans import catalog
from tools_check import digest

SF = "/root/testdata/sf0.001"
TABLES = ["events", "documents"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    missing = set(catalog.QUERIES) - set(entry.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "ad_revenue" in df.columns
