"""Every registered query with SQL against DuckDB on the smallest tables; every other one runs."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from sievework.plans import registry

DATA = os.environ.get("SIEVEWORK_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def rows(df):
    def plain(v):
        if v is None or v is pd.NA or isinstance(v, (float, np.floating)) and v != v:
            return "NULL"
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        if isinstance(v, (int, float, np.integer, np.floating)):
            return repr(round(float(v), 6))
        return str(list(v) if isinstance(v, np.ndarray) else v)

    return sorted(tuple(plain(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, DATA).toPandas()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = duck.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
