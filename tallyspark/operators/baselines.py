"""Rule baselines (M11) and the points-by-slot baseline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import le_or_zero
from .ordered import with_scalar


def classification_rules(df: DataFrame, grid: str = "grid_position", quali: str = "quali_position") -> DataFrame:
    """Slot <= 10 / <= 3 rules; a null slot predicts 0."""
    return df.withColumns({
        "grid_top10": le_or_zero(F.col(grid), 10), "quali_top10": le_or_zero(F.col(quali), 10),
        "grid_podium": le_or_zero(F.col(grid), 3), "quali_podium": le_or_zero(F.col(quali), 3),
    })


@dataclass
class PointsBaseline:
    by_slot: DataFrame      # slot -> mean target, one row per distinct slot
    global_mean: DataFrame  # one row


def fit_points_baseline(train: DataFrame, slot: str, target: str) -> PointsBaseline:
    """Mean target per slot value (null slots excluded) and overall."""
    by_slot = (train.filter(F.col(slot).isNotNull()).groupBy(slot)
                    .agg(F.avg(target).alias("_slot_mean")))
    return PointsBaseline(by_slot, train.agg(F.avg(target).alias("_global_mean")))


def predict_points_baseline(df: DataFrame, fitted: PointsBaseline, slot: str, out: str) -> DataFrame:
    """Left join on the slot, fall back to the global mean, clip at 0.

    The slot table has one row per distinct slot value; its size decides at run
    time how it is joined. The global mean is a one-row scalar."""
    x = df.join(fitted.by_slot, slot, "left")
    x = with_scalar(x, fitted.global_mean)
    return x.withColumn(out, F.greatest(F.coalesce(F.col("_slot_mean"), F.col("_global_mean")), F.lit(0.0))) \
            .drop("_slot_mean", "_global_mean")
