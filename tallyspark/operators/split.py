"""Chronological split, weights and imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..spec import DEFAULT_SPEC, PanelSpec, SplitSpec
from .ordered import with_scalar
from .roles import START, model_columns


def split_label(df: DataFrame, sp: SplitSpec, season: str = "season", name: str = "split") -> DataFrame:
    """L1: one label column; the parts are disjoint by construction."""
    s = F.col(season)
    lo, hi = sp.train_seasons
    lab = (F.when(s.between(lo, hi), "train").when(s == sp.validation_season, "validation")
            .when(s == sp.test_season, "test").when(s == sp.live_season, "live"))
    return df.withColumn(name, lab)


def check_split(labelled: DataFrame, name: str = "split",
                required: Sequence[str] = ("train", "validation", "test")) -> dict[str, int]:
    """L1 emptiness checks (a tiny grouped count reaches the driver)."""
    counts = {r[name]: r["n"] for r in labelled.groupBy(name).agg(F.count(F.lit(1)).alias("n")).collect()}
    for part in required:
        if not counts.get(part):
            raise ValueError(f"{part} split is empty")
    return counts


def live_training_rows(df: DataFrame, sp: SplitSpec, cutoff_round: int | None,
                       season: str = "season", round_: str = "round") -> DataFrame:
    """L2: all closed seasons plus the live season up to the cutoff round."""
    closed = F.col(season).between(sp.train_seasons[0], sp.test_season)
    live = F.col(season) == sp.live_season
    if cutoff_round is not None:
        live = live & (F.col(round_) <= cutoff_round)
    return df.filter(closed | live)


def season_weight(sp: SplitSpec, season: str = "season") -> Column:
    """L3: step weights by season."""
    s = F.col(season)
    expr = F.lit(float(sp.live_weight))
    for bound, w in reversed(sp.weight_steps):
        expr = F.when(s <= bound, F.lit(float(w))).otherwise(expr)
    return expr


def drop_null_targets(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """P31."""
    return df.na.drop(subset=list(targets))


def imbalance_weight(df: DataFrame, label: str) -> DataFrame:
    """One-row table with ``max(1, neg/pos)`` (1 without a positive row)."""
    return df.agg(F.greatest(F.lit(1.0), F.try_divide(
        F.sum((1 - F.col(label)).cast("double")), F.sum(F.col(label).cast("double")))).alias("pos_weight"))


class MedianImputer:
    """Exact per-column median fitted on one frame, applied to others.

    Medians come from ``quantiles.column_medians`` (value histograms and
    distributed running counts: no task gathers a column).  Columns that are
    null on the whole fit frame are dropped, as the original imputer does.
    The fitted medians are a one-row table attached as a scalar; only the
    list of all-null columns reaches the driver."""

    def __init__(self, cols: Sequence[str]):
        self.cols = list(cols)
        self.medians: DataFrame | None = None
        self.kept: list[str] = []

    def fit(self, df: DataFrame) -> "MedianImputer":
        from ..session import materialize
        from .quantiles import column_medians
        self.medians = materialize(column_medians(df, self.cols), "medians")  # one row
        row = self.medians.first()
        self.kept = [c for c in self.cols if row[c] is not None]
        self.medians = self.medians.select(*self.kept)
        return self

    def values(self) -> dict[str, float]:
        """The fitted medians, for an artifact."""
        return {c: float(v) for c, v in self.medians.first().asDict().items()}

    @classmethod
    def of(cls, spark: SparkSession, medians: dict[str, float], order: Sequence[str]) -> "MedianImputer":
        """An imputer with known medians, as if fitted."""
        out = cls(order)
        out.kept = list(order)
        out.medians = spark.createDataFrame([tuple(float(medians[c]) for c in order)],
                                            ", ".join(f"`{c}` double" for c in order))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        if self.medians is None:
            raise RuntimeError("fit first")
        med = self.medians.select(*[F.col(c).alias(f"_med_{c}") for c in self.kept])
        x = with_scalar(df, med)
        x = x.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}")) for c in self.kept})
        return x.drop(*[f"_med_{c}" for c in self.kept])


def numeric_feature_columns(df: DataFrame, mode: str = "post_quali", spec: PanelSpec = DEFAULT_SPEC) -> list[str]:
    """The numeric columns that a model of this mode may see, by role;
    before qualifying the starting order and what derives from it is unknown."""
    hidden = {"post_quali": set(), "pre_quali": {START}}
    if mode not in hidden:
        raise ValueError(f"unknown mode {mode!r}: one of {', '.join(hidden)}")
    roles = model_columns(spec)
    return sorted(f.name for f in df.schema.fields
                  if isinstance(f.dataType, NumericType) and f.name in roles and roles[f.name] not in hidden[mode])
