"""Top-N prediction tables.

Top-N per event is two-stage so that a huge event never sorts in one task:
rows are ranked inside (event, salt) buckets, only the best ``n`` of each
bucket survive (the global top ``n`` is always among them), and the final
rank runs on at most ``n x salts`` rows per event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                    rank_col: str = "predicted_rank", salt_on: str | None = None,
                    salts: int = 32) -> DataFrame:
    """Exact top-``n`` rows per ``keys`` with a 1-based rank column."""
    keys = list(keys)
    x = df
    if salt_on is not None and salts > 1:
        x = x.withColumn("_salt", F.pmod(F.xxhash64(F.col(salt_on)), F.lit(salts)))
        w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
        x = x.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= n).drop("_r1", "_salt")
    w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
    return x.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def best_row_per(df: DataFrame, keys: Sequence[str], dedupe: str, best: Sequence[str]) -> DataFrame:
    """The row with the largest values of ``best`` per (keys, dedupe
    id). One aggregate, partial per task: structs compare field by field with
    nulls lowest, so a null score loses against any score and text keys work
    as well; rows that tie in ``best`` are told apart by their other columns."""
    rest = [c for c in df.columns if c not in (*keys, dedupe, *best)]
    agg = df.groupBy(*keys, dedupe).agg(F.max(F.struct(*best, *rest)).alias("_r"))
    return agg.select(*[F.col(c) if c in (*keys, dedupe) else F.col(f"_r.{c}").alias(c) for c in df.columns])


def predict_top_n(scored: DataFrame, event: Sequence[str], entity: str, n: int = 10,
                  score_cols: Sequence[str] = ("race_rank_score", "expected_points", "proba_podium",
                                               "proba_top10")) -> DataFrame:
    """O3: 4-key descending order, one row per entity, top ``n`` per event,
    rank 1..n (ties broken by the entity id)."""
    order = [F.col(c).desc_nulls_last() for c in score_cols] + [F.col(entity).asc()]
    dedup = best_row_per(scored, event, entity, score_cols)
    return top_n_per_group(dedup, event, order, n, salt_on=entity)


def label_mode(df: DataFrame, keys: Sequence[str], col: str, out: str = "confidence_mode") -> DataFrame:
    """Most frequent label per key; ties go to the alphabetically first."""
    return df.groupBy(*keys).agg(F.mode(col, deterministic=True).alias(out))
