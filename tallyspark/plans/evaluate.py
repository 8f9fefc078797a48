"""Train and evaluate model families on a chronological split.

For each family (pre / post qualifying feature schema): fit on the train
seasons, tune the classification thresholds on the validation season only
(D5), apply them to validation and test, and report classification,
regression and ranking metrics in long form (family, split, task, metric,
value).  Models and thresholds can be written as artifacts (S12, S13).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import models as ML
from ..operators.report import metrics_long
from ..session import materialize
from ..operators.split import numeric_feature_columns, season_weight, split_label
from ..spec import DEFAULT_SPLIT, SplitSpec

CLS_METRICS = ["accuracy", "precision", "recall", "f1", "brier_score", "roc_auc", "average_precision"]
REG_METRICS = ["mae", "rmse", "r2", "spearman"]
RANK_METRICS = ["precision_at_10", "recall_at_10", "top10_overlap", "ndcg_at_10"]


def _task_rows(scored: DataFrame, thresholds: DataFrame | None) -> DataFrame:
    cols = ["split", "season", "round", "driver_id"]
    a = scored.select(*cols, F.lit("top10").alias("task"), F.col("target_top10").alias("label"),
                      F.col("proba_top10").alias("proba"))
    b = scored.select(*cols, F.lit("podium").alias("task"), F.col("target_podium").alias("label"),
                      F.col("proba_podium").alias("proba"))
    t = a.unionByName(b)
    if thresholds is None:
        return t.withColumn("threshold", F.lit(0.5)).withColumn("pred", (F.col("proba") >= 0.5).cast("int"))
    t = t.join(F.broadcast(thresholds.select("task", "threshold")), "task", "left")  # two rows
    return t.withColumn("pred", (F.col("proba") >= F.coalesce(F.col("threshold"), F.lit(0.5))).cast("int"))


def evaluate_family(panel: DataFrame, mode: str, params: ML.TreeParams, sp: SplitSpec = DEFAULT_SPLIT,
                    entity: str = "driver_id") -> tuple[ML.Family, DataFrame, DataFrame]:
    """Returns (family, thresholds per task, long metrics)."""
    return _evaluate(panel, (mode,), params, sp, entity)[mode]


def _evaluate(panel: DataFrame, modes: tuple[str, ...], params: ML.TreeParams, sp: SplitSpec, entity: str) -> dict[str, tuple]:
    """All families from one training run; early stopping, where asked for,
    looks at the validation season."""
    lab = split_label(panel, sp).withColumn("weight", season_weight(sp))
    feats = {m: [c for c in numeric_feature_columns(lab, m) if c != "season"] for m in modes}
    valid = lab.filter(F.col("split") == "validation") if params.early_stopping else None
    held, out = lab.filter(F.col("split").isin("validation", "test")), {}
    for mode, fam in ML.train_families(lab.filter(F.col("split") == "train"), feats, params, valid=valid).items():
        # every metric reads the scored rows, so they are written once
        scored = materialize(ML.score_family(fam, held), "scored")
        out[mode] = (fam, *family_metrics(fam, scored, mode, entity))
    return out


def tuned_thresholds(scored: DataFrame) -> DataFrame:
    """The F1-best threshold of each classification task on validation."""
    raw = _task_rows(scored, None).filter(F.col("split") == "validation")
    return M.best_f1_threshold(raw, ["task"], "label", "proba")


def family_metrics(fam: ML.Family, scored: DataFrame, mode: str,
                   entity: str = "driver_id") -> tuple[DataFrame, DataFrame]:
    """Thresholds tuned on validation, then long metrics for both splits."""
    thr = tuned_thresholds(scored)
    tasks = _task_rows(scored, thr)
    cls = M.classification_metrics(tasks, ["split", "task"], "label", "pred", "proba")
    reg = M.regression_metrics(scored, ["split"], "target_points", "expected_points") \
           .withColumn("task", F.lit("points"))
    rank_col = "rank_model_score" if fam.ranker is not None else "expected_points"
    rnk = M.ranking_at_k(scored, ["season", "round"], ["split"], rank_col, "position_order", "target_top10",
                         entity).withColumn("task", F.lit("ranking"))
    ids = ["model_family", "split", "task"]
    long = (metrics_long(cls.withColumn("model_family", F.lit(mode)), ids, CLS_METRICS)
            .unionByName(metrics_long(reg.withColumn("model_family", F.lit(mode)), ids, REG_METRICS))
            .unionByName(metrics_long(rnk.withColumn("model_family", F.lit(mode)), ids, RANK_METRICS)))
    return thr, long


def evaluate_families(panel: DataFrame, params: ML.TreeParams, sp: SplitSpec = DEFAULT_SPLIT,
                      modes: tuple[str, ...] = ("pre_quali", "post_quali"),
                      artifact_dir: str | None = None) -> DataFrame:
    """Every family, one long metrics table; optional artifacts."""
    out = None
    for mode, (fam, thr, long) in _evaluate(panel, modes, params, sp, "driver_id").items():
        if artifact_dir:
            from .artifacts import save_family
            save_family(panel.sparkSession, fam, {r["task"]: r["threshold"] for r in thr.collect()}, artifact_dir,
                        "evaluation", mode, {"season": sp.train_seasons[1], "round": None})  # two thresholds
        out = long if out is None else out.unionByName(long)
    return out
