"""Sinks and artifacts.

Every writer is a distributed ``DataFrame.write``; small report dicts (a
metrics summary, thresholds, a feature list) go through the driver as JSON,
as they are bounded by the number of metrics, not rows.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite") -> str:
    """Table sink (parquet by default, csv with a header on request)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path


def write_json_lines(df: DataFrame, path: str) -> str:
    """S12 for tables: one JSON object per row."""
    df.write.mode("overwrite").json(path)
    return path


def save_small_json(spark: SparkSession, data, path: str) -> str:
    """S12 for a small dict/list (metrics, thresholds, column lists): one
    text file through the Hadoop file system (works on any shared store)."""
    text = json.dumps(data, indent=2, sort_keys=True, default=float)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def load_small_json(spark: SparkSession, path: str):
    rows = spark.read.text(path, wholetext=True).collect()
    return json.loads(rows[0]["value"])


def save_model(model: PipelineModel, root: str, family: str, name: str) -> str:
    """Versioned model artifact ``root/family/name``."""
    path = f"{root.rstrip('/')}/{family}/{name}"
    model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, root: str, name: str, families: list[str]) -> PipelineModel:
    """Load from the first family folder that has the artifact
    (e.g. ``["live", "evaluation"]``: live models, else the fallback)."""
    from ..sources.tables import _path_exists
    for fam in families:
        path = f"{root.rstrip('/')}/{fam}/{name}"
        if _path_exists(spark, path):
            return PipelineModel.load(path)
    raise FileNotFoundError(f"no model {name} under {root} in {families}")
