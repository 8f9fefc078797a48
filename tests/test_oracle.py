"""Every registered query against its DuckDB oracle (the driver's gate).

Runs at sf0.001 by default; ``TALLY_TEST_SF=0.01`` reproduces the driver's
scale."""
import hashlib
import os

import duckdb
import pandas as pd
import pytest

from tallyspark.plans.registry import load_all
from tallyspark.sources.tables import TESTDATA_TABLES

from conftest import SF_DIR

QUERIES = {name: e.fn for name, e in load_all().items()}
ORACLE = {name: e.sql for name, e in load_all().items() if e.sql is not None}


def _norm(df: pd.DataFrame) -> list[str]:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "f":
            df[c] = df[c].round(6)
        df[c] = df[c].map(lambda v: None if v is None or (isinstance(v, float) and v != v) else v).astype(str)
    return sorted("|".join(r) for r in df.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TESTDATA_TABLES:
        p = os.path.join(SF_DIR, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def test_every_query_is_registered_with_ops():
    from tallyspark.plans.registry import load_all
    for name, e in load_all().items():
        assert e.ops, name


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert hashlib.sha256("\n".join(_norm(got)).encode()).digest() == \
        hashlib.sha256("\n".join(_norm(want)).encode()).digest()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert df.count() > 0
