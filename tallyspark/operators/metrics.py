"""Evaluation metrics as aggregates.

Every metric is computed per ``by`` group (family, split, task...) on the
scored DataFrame.  Order-based metrics (ROC-AUC, average precision, Spearman,
ranking@k) first collapse rows into score histograms (partial aggregation)
and take running totals with ``ordered.prefix_sums``, so a large split never
sits in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import position_within, prefix_sums, with_scalar


def _sd(a, b):
    return F.try_divide(a.cast("double"), F.nullif(b, F.lit(0)).cast("double"))


def confusion_counts(df: DataFrame, by: Sequence[str], label: str, pred: str, proba: str | None = None) -> DataFrame:
    """M1-M3 in one pass: tp/fp/fn/tn, accuracy, precision, recall, F1
    (zero_division=0), Brier score and the 2x2 confusion matrix."""
    y, p = F.col(label), F.col(pred)
    aggs = [
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.sum(((y == 1) & (p == 1)).cast("int")).cast("bigint").alias("tp"),
        F.sum(((y == 0) & (p == 1)).cast("int")).cast("bigint").alias("fp"),
        F.sum(((y == 1) & (p == 0)).cast("int")).cast("bigint").alias("fn"),
        F.sum(((y == 0) & (p == 0)).cast("int")).cast("bigint").alias("tn"),
    ]
    if proba:
        aggs.append(F.avg(F.pow(F.col(proba) - y, 2)).alias("brier_score"))
    c = df.groupBy(*by).agg(*aggs)
    tp, fp, fn, tn, n = (F.col(x) for x in ("tp", "fp", "fn", "tn", "n"))
    return c.withColumns({
        "accuracy": _sd(tp + tn, n),
        "precision": F.coalesce(_sd(tp, tp + fp), F.lit(0.0)),
        "recall": F.coalesce(_sd(tp, tp + fn), F.lit(0.0)),
        "f1": F.coalesce(_sd(2 * tp, 2 * tp + fp + fn), F.lit(0.0)),
        "confusion_matrix": F.array(F.array(tn, fp), F.array(fn, tp)),
    })


def score_histogram(df: DataFrame, by: Sequence[str], label: str, proba: str) -> DataFrame:
    """Rows -> (by, score, pos, neg): ties collapse, partial aggregation."""
    y = F.col(label)
    return df.groupBy(*by, F.col(proba).alias("_s")).agg(
        F.sum(y.cast("bigint")).alias("_pos"), F.sum((1 - y).cast("bigint")).alias("_neg"))


def auc_ap(df: DataFrame, by: Sequence[str], label: str, proba: str) -> DataFrame:
    """M4 ROC-AUC (ties count one half; null with a single class) and M5
    step-wise average precision (tied scores form one step)."""
    h = score_histogram(df, by, label, proba)
    h = prefix_sums(h, by, [("_s", False)], ["_pos", "_neg"])
    tot = h.groupBy(*by).agg(
        F.sum("_pos").alias("P"), F.sum("_neg").alias("N"),
        F.sum(F.col("_neg") * (F.col("cum__pos") - F.col("_pos") / 2.0)).alias("_auc_num"),
        F.sum(F.col("_pos") * _sd(F.col("cum__pos"), F.col("cum__pos") + F.col("cum__neg"))).alias("_ap_num"))
    return tot.select(
        *by,
        F.when((F.col("P") > 0) & (F.col("N") > 0), _sd(F.col("_auc_num"), F.col("P") * F.col("N"))).alias("roc_auc"),
        _sd(F.col("_ap_num"), F.col("P")).alias("average_precision"))


def classification_metrics(df: DataFrame, by: Sequence[str], label: str, pred: str, proba: str) -> DataFrame:
    """M1-M5 per group."""
    return confusion_counts(df, by, label, pred, proba).join(auc_ap(df, by, label, proba), list(by), "left")


def average_ranks(df: DataFrame, by: Sequence[str], col: str, out: str) -> DataFrame:
    """Average rank (1-based, ties share the mean position) of ``col`` within
    ``by``: a value histogram, distributed running counts, join back."""
    h = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("_c"))
    h = prefix_sums(h, by, [(col, True)], ["_c"])
    h = h.select(*by, col, (F.col("cum__c") - (F.col("_c") - 1) / 2.0).alias(out))
    return df.join(h, [*by, col], "left")


def regression_metrics(df: DataFrame, by: Sequence[str], label: str, pred: str) -> DataFrame:
    """M6 MAE, RMSE, R2 and M7 Spearman correlation (average ranks)."""
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    base = df.groupBy(*by).agg(
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg(F.pow(y - p, 2))).alias("rmse"),
        (1 - _sd(F.sum(F.pow(y - p, 2)), F.var_pop(y) * F.count(F.lit(1)))).alias("r2"))
    r = average_ranks(df.select(*by, label, pred), by, label, "_ry")
    r = average_ranks(r, by, pred, "_rp")
    sp = r.groupBy(*by).agg(F.corr("_ry", "_rp").alias("spearman"))
    return base.join(sp, list(by), "left")


def best_f1_threshold(df: DataFrame, by: Sequence[str], label: str, proba: str,
                      lo: int = 5, hi: int = 95) -> DataFrame:
    """M8: F1-maximising threshold on the grid lo/100 .. hi/100 (step .01);
    the lowest threshold wins ties.  Every score is bucketed once into the
    index of the highest threshold it reaches; counts per bucket are summed
    from the top, so the grid costs (#groups x 92) rows."""
    p = F.col(proba).cast("double")
    i0 = F.floor(p * 100).cast("int")
    idx = (F.when((i0 + 1) / 100.0 <= p, i0 + 1).when(i0 / 100.0 > p, i0 - 1).otherwise(i0))
    idx = F.least(F.greatest(idx, F.lit(lo - 1)), F.lit(hi))
    y = F.col(label)
    b = df.groupBy(*by, idx.alias("_i")).agg(F.sum(y.cast("bigint")).alias("_pos"),
                                            F.sum((1 - y).cast("bigint")).alias("_neg"))
    grid = (df.select(*by).distinct()
              .withColumn("_i", F.explode(F.sequence(F.lit(lo - 1), F.lit(hi)))))
    g = grid.join(b, [*by, "_i"], "left").fillna(0, ["_pos", "_neg"])
    w = Window.partitionBy(*by).orderBy(F.desc("_i")).rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumns({"_tp": F.sum("_pos").over(w), "_fp": F.sum("_neg").over(w),
                       "_P": F.sum("_pos").over(Window.partitionBy(*by))})
    g = g.filter(F.col("_i") >= lo).withColumn(
        "_f1", F.coalesce(_sd(2 * F.col("_tp"), F.col("_tp") + F.col("_fp") + F.col("_P")), F.lit(0.0)))
    best = g.groupBy(*by).agg(F.max_by(F.col("_i"), F.struct(F.col("_f1"), -F.col("_i"))).alias("_bi"),
                              F.max("_f1").alias("best_f1"))
    return best.select(*by, (F.col("_bi") / 100.0).alias("threshold"), "best_f1")


def _dcg_prefix(k: int) -> list[float]:
    """D(m) = sum_{j=1..m} 1/log2(j+1), m = 0..k."""
    out, acc = [0.0], 0.0
    for j in range(1, k + 1):
        acc += 1.0 / math.log2(j + 1)
        out.append(acc)
    return out


def ranking_at_k(df: DataFrame, event: Sequence[str], by: Sequence[str], score: str, finish: str,
                 relevance: str, tie: str, k: int = 10) -> DataFrame:
    """M9 precision@k, recall@k, overlap@k and M10 NDCG@k per event
    (events with fewer than k rows are skipped), averaged per ``by``.

    Positions come from ``position_within`` (distributed row numbers);
    NDCG averages tied scores: each tie group contributes its mean relevance
    times the discounts of the positions it spans."""
    keys = [*by, *event]
    x = df.select(*keys, score, finish, relevance, tie)
    x = position_within(x, keys, [(score, False), (tie, True)], "_pp")
    x = position_within(x, keys, [(finish, True), (tie, True)], "_tp")
    per = x.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(((F.col("_pp") <= k) & (F.col("_tp") <= k)).cast("int")).alias("_hit"),
        F.sum((F.col("_tp") <= k).cast("int")).alias("_tn"),
        F.sum(F.col(relevance).cast("double")).alias("_npos"))
    # tie groups of the score for NDCG
    D = F.array(*[F.lit(v) for v in _dcg_prefix(k)])
    tg = x.groupBy(*keys, score).agg(F.count(F.lit(1)).alias("_c"),
                                     F.avg(F.col(relevance).cast("double")).alias("_mrel"))
    tg = prefix_sums(tg, keys, [(score, False)], ["_c"])
    start = F.col("cum__c") - F.col("_c")  # rows above the tie group
    end = F.col("cum__c")
    disc = (F.element_at(D, F.least(end, F.lit(k)).cast("int") + 1)
            - F.element_at(D, F.least(start, F.lit(k)).cast("int") + 1))
    dcg = tg.groupBy(*keys).agg(F.sum(F.col("_mrel") * disc).alias("_dcg"))
    per = per.join(dcg, keys, "left")
    idcg = F.element_at(D, F.least(F.col("_npos"), F.lit(float(k))).cast("int") + 1)
    per = per.filter(F.col("_n") >= k).withColumns({
        "precision_at_10": F.col("_hit") / float(k),
        "recall_at_10": F.col("_hit") / F.greatest(F.lit(1), F.col("_tn")),
        "top10_overlap": F.col("_hit").cast("double"),
        "ndcg_at_10": F.when(idcg > 0, F.col("_dcg") / idcg).otherwise(F.lit(0.0)),
    })
    return per.groupBy(*by).agg(
        F.avg("precision_at_10").alias("precision_at_10"), F.avg("recall_at_10").alias("recall_at_10"),
        F.avg("top10_overlap").alias("top10_overlap"), F.avg("ndcg_at_10").alias("ndcg_at_10"),
        F.count(F.lit(1)).cast("bigint").alias("n_events"))


def roc_curve(df: DataFrame, by: Sequence[str], label: str, proba: str) -> DataFrame:
    """ROC and precision-recall curve points (one per distinct score,
    descending), as a table instead of a plot."""
    h = score_histogram(df, by, label, proba)
    h = prefix_sums(h, by, [("_s", False)], ["_pos", "_neg"])
    tot = h.groupBy(*by).agg(F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
    h = h.join(tot, list(by), "left") if by else with_scalar(h, tot)
    return h.select(*by, F.col("_s").alias("threshold"),
                    _sd(F.col("cum__neg"), F.col("_N")).alias("fpr"),
                    _sd(F.col("cum__pos"), F.col("_P")).alias("tpr"),
                    _sd(F.col("cum__pos"), F.col("cum__pos") + F.col("cum__neg")).alias("precision"))
