"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["image", "caption", "pmid", "pmcid", "pair_id", "split"]
    assert df.count() >= 0
