"""Query catalogue: each entry pairs a Spark query with its DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame``; the oracle is ANSI SQL over the
pre-registered parquet views, or ``None`` when the result is not expressible
in SQL (model fits, streaming), in which case only rows are checked.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


@dataclass(frozen=True)
class Entry:
    name: str
    fn: Callable
    sql: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None, ops: tuple[str, ...] | str = ()):
    if isinstance(ops, str):
        ops = tuple(o.strip() for o in ops.split(",") if o.strip())

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, ops)
        return fn
    return deco


def present(df: DataFrame, cols: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Select ``cols`` and round double columns at output (both engines
    round the same way, so float summation order cannot flip a hash)."""
    if cols is not None:
        df = df.select(*cols)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.round(c, digits).alias(f.name)
        out.append(c)
    return df.select(*out)


def load_all() -> dict[str, Entry]:
    # import for side effects: each module registers its queries
    from . import (catalog_history, catalog_ingest, catalog_quality,  # noqa: F401
                   catalog_metrics, catalog_future, catalog_ml, catalog_panel)
    return REGISTRY
