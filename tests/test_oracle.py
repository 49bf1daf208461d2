"""Every registered query against its DuckDB oracle on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import TABLES, digest, frame_rows

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    if name not in ORACLE:
        assert len(got) > 0
        return
    want = con.execute(ORACLE[name]).df()
    gc, gr = frame_rows(got)
    wc, wr = frame_rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert digest(gr) == digest(wr)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and len(df.columns) == 123
