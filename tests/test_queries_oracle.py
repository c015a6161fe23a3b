"""Every registered query against its DuckDB oracle (the driver's gate, at sf0.001)."""
import duckdb
import pytest

import __spark_entry__ as E
from airnet.plans import QUERIES
from tools.check_oracle import TABLES, _norm

SF = "/root/testdata/sf0.001"
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "value_zscore" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = E.queries()[name](spark, SF)
    if name not in ORACLE:
        rows = df.collect()
        assert rows and all(v is not None for v in rows[0])
        return
    got = df.toPandas()
    exp = con.execute(ORACLE[name]).fetchdf()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert len(got) == 0 or _norm(got).equals(_norm(exp))
