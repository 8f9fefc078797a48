"""Queries with an SQL form against DuckDB, and the list of queries."""
import os
import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tallyspark.llm import catalog

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(df: pd.DataFrame) -> list[str]:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "f":
            df[c] = df[c].round(6)
        df[c] = df[c].map(lambda v: None if v is None or v != v else v).astype(str).str.replace(r"\.0$", "", regex=True)
    return sorted("|".join(r) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{os.path.join(sf_dir, t)}.parquet')")
    want = con.execute(catalog.ORACLE_SQL[name]).df()
    got = catalog.QUERIES[name](spark, sf_dir).toPandas()
    assert sorted(got.columns) == sorted(want.columns) and len(got)
    assert norm(got) == norm(want)


def test_one_query_for_each_operator_and_the_pipeline():
    names = entry.queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
