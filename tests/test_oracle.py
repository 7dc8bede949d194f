"""Every registered query against its DuckDB oracle at sf0.001 (the driver's check, smaller)."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from retally.registry import QUERIES
from tools.oracle_check import TABLES, _bag

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() >= 0 and len(df.columns) == 16


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    srows, scols = [tuple(r) for r in df.collect()], list(df.columns)
    rel = con.execute(oracle_sql()[name])
    ocols, orows = [d[0] for d in rel.description], rel.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert _bag(scols, srows) == _bag(ocols, orows)
