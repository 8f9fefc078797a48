"""Long-form metric reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def metrics_long(wide: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """U8: (ids..., metric, value) rows; nested structures never enter."""
    return wide.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics]) \
               .unpivot(list(ids), list(metrics), "metric", "value")


def metrics_wide(long: DataFrame, ids: Sequence[str], pivot_col: str, values: Sequence[str],
                 metrics: Sequence[str]) -> DataFrame:
    """One column per (pivot value, metric); both are known to the
    caller, so no job looks for them and the schema does not hang on the data."""
    keyed = long.withColumn("_k", F.concat_ws("_", F.col(pivot_col), F.col("metric")))
    return keyed.groupBy(*ids).pivot("_k", [f"{v}_{m}" for v in values for m in metrics]).agg(F.max("value"))


def comparison_table(frames: dict[str, DataFrame], ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Union of per-family metric tables, long form."""
    out = None
    for fam, df in frames.items():
        part = metrics_long(df.withColumn("model_family", F.lit(fam)), ["model_family", *ids], metrics)
        out = part if out is None else out.unionByName(part)
    return out
