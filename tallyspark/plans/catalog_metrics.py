"""Catalogue: split, weights, imputation, baselines and metrics (L1-L3, A20-A21,
M1-M13, J15, U8-U9).

Metric queries score the panel with a deterministic formula so the oracle
can restate them in SQL without a model:
``proba = 1 / (1 + coalesce(grid_position, quali_position, 30))``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import le_or_zero
from ..operators import metrics as M
from ..operators import split as SPL
from ..operators.history import entity_history
from ..spec import DEFAULT_SPEC, DEFAULT_SPLIT
from .catalog_history import _driver_form_sql
from .catalog_quality import SPLIT_CASE
from .panel import prepared_panel
from .registry import present, register
from .sqltext import with_prep

S = DEFAULT_SPEC
SP = DEFAULT_SPLIT

PROBA_SQL = "1.0 / (1 + coalesce(grid_position, quali_position, 30))"
POINTS_SQL = "greatest(0.0, 12.0 - 0.5 * coalesce(grid_position, quali_position, 30))"
EVAL = "split in ('validation', 'test')"


def _labelled(spark, sf_dir) -> DataFrame:
    return SPL.split_label(prepared_panel(spark, sf_dir), SP)


def _eval_rows(spark, sf_dir) -> DataFrame:
    p = _labelled(spark, sf_dir).filter(F.col("split").isin("validation", "test"))
    g = F.coalesce(F.col("grid_position"), F.col("quali_position"), F.lit(30))
    return p.withColumns({
        "proba": 1.0 / (1 + g),
        "points_pred": F.greatest(F.lit(0.0), 12.0 - 0.5 * g),
    })


def _tasks(x: DataFrame) -> DataFrame:
    top10 = x.select("split", "season", "round", "driver_id", "position_order", "proba",
                     F.lit("top10").alias("task"), F.col("target_top10").alias("label"),
                     (F.col("proba") >= 0.09).cast("int").alias("pred"))
    podium = x.select("split", "season", "round", "driver_id", "position_order", "proba",
                      F.lit("podium").alias("task"), F.col("target_podium").alias("label"),
                      (F.col("proba") >= 0.25).cast("int").alias("pred"))
    return top10.unionByName(podium)


SCORED_SQL = with_prep(
    f"l as (select *, {SPLIT_CASE} as split from p)",
    f"e as (select *, {PROBA_SQL} as proba, {POINTS_SQL} as points_pred from l where {EVAL})",
    "t as (select split, season, round, driver_id, position_order, proba, 'top10' as task, target_top10 as label, "
    "cast(proba >= 0.09 as int) as pred from e union all "
    "select split, season, round, driver_id, position_order, proba, 'podium', target_podium, "
    "cast(proba >= 0.25 as int) from e)")

_AUC_SQL = """h as (select split, task, proba as s, sum(label) as pos, sum(1 - label) as neg from t group by split, task, proba),
hc as (select *, sum(pos) over (partition by split, task order by s desc rows between unbounded preceding and current row) as cp,
                 sum(neg) over (partition by split, task order by s desc rows between unbounded preceding and current row) as cn from h),
auc as (select split, task,
   case when sum(pos) > 0 and sum(neg) > 0 then sum(neg * (cp - pos / 2.0)) / (sum(pos) * sum(neg)) end as roc_auc,
   sum(pos * (cp / (cp + cn))) / nullif(sum(pos), 0) as average_precision from hc group by split, task)"""


M1_SQL = SCORED_SQL.rstrip() + ",\n" + _AUC_SQL + """
select c.split, c.task, c.n, c.tp, c.fp, c.fn, c.tn,
  round(cast(c.tp + c.tn as double) / c.n, 6) as accuracy,
  round(coalesce(c.tp / nullif(cast(c.tp + c.fp as double), 0), 0), 6) as precision,
  round(coalesce(c.tp / nullif(cast(c.tp + c.fn as double), 0), 0), 6) as recall,
  round(coalesce(2 * c.tp / nullif(cast(2 * c.tp + c.fp + c.fn as double), 0), 0), 6) as f1,
  round(c.brier_score, 6) as brier_score, round(a.roc_auc, 6) as roc_auc, round(a.average_precision, 6) as average_precision
from (select split, task, cast(count(*) as bigint) as n,
        cast(sum(case when label = 1 and pred = 1 then 1 else 0 end) as bigint) as tp,
        cast(sum(case when label = 0 and pred = 1 then 1 else 0 end) as bigint) as fp,
        cast(sum(case when label = 1 and pred = 0 then 1 else 0 end) as bigint) as fn,
        cast(sum(case when label = 0 and pred = 0 then 1 else 0 end) as bigint) as tn,
        avg(pow(proba - label, 2)) as brier_score from t group by split, task) c
left join auc a on c.split = a.split and c.task = a.task"""


@register("m1_classification_metrics", M1_SQL, "M1,M2,M3,M4,M5,P22")
def q_m1(spark, sf_dir):
    t = _tasks(_eval_rows(spark, sf_dir))
    m = M.classification_metrics(t, ["split", "task"], "label", "pred", "proba")
    return present(m.drop("confusion_matrix"))


@register("m13_roc_pr_curve", SCORED_SQL.rstrip() + ",\n" + _AUC_SQL + """
select hc.split, hc.task, round(hc.s, 6) as threshold,
  round(hc.cn / cast(sum(hc.neg) over (partition by hc.split, hc.task) as double), 6) as fpr,
  round(hc.cp / cast(sum(hc.pos) over (partition by hc.split, hc.task) as double), 6) as tpr,
  round(hc.cp / cast(hc.cp + hc.cn as double), 6) as precision
from hc""", "M13")
def q_m13(spark, sf_dir):
    t = _tasks(_eval_rows(spark, sf_dir))
    return present(M.roc_curve(t, ["split", "task"], "label", "proba"))


def _regression_sql(pred_sql_cte: str, pred_col: str) -> str:
    return pred_sql_cte + f""",
rk as (select *, rank() over (partition by split order by target_points) + (count(*) over (partition by split, target_points) - 1) / 2.0 as ry,
              rank() over (partition by split order by {pred_col}) + (count(*) over (partition by split, {pred_col}) - 1) / 2.0 as rp
       from r)
select split, round(avg(abs(target_points - {pred_col})), 6) as mae,
  round(sqrt(avg(pow(target_points - {pred_col}, 2))), 6) as rmse,
  round(1 - sum(pow(target_points - {pred_col}, 2)) / nullif(var_pop(target_points) * count(*), 0), 6) as r2,
  round(corr(ry, rp), 6) as spearman
from rk group by split"""


@register("m6_regression_metrics", _regression_sql(
    SCORED_SQL.rstrip() + ",\nr as (select split, target_points, points_pred from e)", "points_pred"), "M6,M7,P23")
def q_m6(spark, sf_dir):
    x = _eval_rows(spark, sf_dir)
    return present(M.regression_metrics(x, ["split"], "target_points", "points_pred"))


@register("m8_best_threshold", SCORED_SQL.rstrip() + """,
g as (select distinct split, task, i from t, range(5, 96) r(i)),
f as (select g.split, g.task, g.i,
        sum(case when t.proba >= g.i / 100.0 and t.label = 1 then 1 else 0 end) as tp,
        sum(case when t.proba >= g.i / 100.0 and t.label = 0 then 1 else 0 end) as fp,
        sum(t.label) as pos
      from g join t on g.split = t.split and g.task = t.task group by g.split, g.task, g.i),
s as (select split, task, i, coalesce(2.0 * tp / nullif(tp + fp + pos, 0), 0) as f1 from f)
select split, task, round(i / 100.0, 6) as threshold, round(f1, 6) as best_f1
from s qualify row_number() over (partition by split, task order by f1 desc, i) = 1""", "M8")
def q_m8(spark, sf_dir):
    t = _tasks(_eval_rows(spark, sf_dir))
    return present(M.best_f1_threshold(t, ["split", "task"], "label", "proba"))


def _ndcg_sql():
    return SCORED_SQL.rstrip() + """,
s as (select split, season, round, driver_id, position_order, proba, target_top10 from e),
pp as (select *, row_number() over (partition by split, season, round order by proba desc, driver_id) as ppos,
                 row_number() over (partition by split, season, round order by position_order, driver_id) as tpos from s),
per as (select split, season, round, count(*) as n,
          sum(case when ppos <= 10 and tpos <= 10 then 1 else 0 end) as hit,
          sum(case when tpos <= 10 then 1 else 0 end) as tn, sum(target_top10) as npos
        from pp group by split, season, round),
dd as (select m, (select coalesce(sum(1.0 / log2(j + 1)), 0) from range(1, m + 1) q(j)) as dm from range(0, 11) r(m)),
tg as (select split, season, round, proba, count(*) as c, avg(target_top10) as mrel from s group by split, season, round, proba),
tgc as (select *, sum(c) over (partition by split, season, round order by proba desc
                               rows between unbounded preceding and current row) as cum from tg),
dcg as (select tgc.split, tgc.season, tgc.round, sum(tgc.mrel * (d1.dm - d0.dm)) as dcg
        from tgc join dd d1 on d1.m = least(tgc.cum, 10) join dd d0 on d0.m = least(tgc.cum - tgc.c, 10)
        group by tgc.split, tgc.season, tgc.round),
ev as (select per.*, dcg.dcg, di.dm as idcg from per join dcg using (split, season, round)
       join dd di on di.m = least(per.npos, 10) where per.n >= 10)
select split, round(avg(hit / 10.0), 6) as precision_at_10, round(avg(hit / greatest(1, tn)), 6) as recall_at_10,
  round(avg(cast(hit as double)), 6) as top10_overlap,
  round(avg(case when idcg > 0 then dcg / idcg else 0 end), 6) as ndcg_at_10, cast(count(*) as bigint) as n_events
from ev group by split"""


@register("m9_ranking_metrics", _ndcg_sql(), "M9,M10,U4")
def q_m9(spark, sf_dir):
    x = _eval_rows(spark, sf_dir)
    return present(M.ranking_at_k(x, ["season", "round"], ["split"], "proba", "position_order",
                                  "target_top10", "driver_id"))


RULES = {"grid_top10": ("grid_position", 10, "target_top10"), "quali_top10": ("quali_position", 10, "target_top10"),
         "grid_podium": ("grid_position", 3, "target_podium"), "quali_podium": ("quali_position", 3, "target_podium")}


@register("m11_rule_baselines", with_prep(f"l as (select *, {SPLIT_CASE} as split from p where season in (1999, 2000))",
                                          "t as (" + " union all ".join(
    f"select split, '{r}' as rule, {lab} as label, cast(coalesce({c} <= {n}, false) as int) as pred from l"
    for r, (c, n, lab) in RULES.items()) + ")") + """,
h as (select split, rule, pred as s, sum(label) as pos, sum(1 - label) as neg from t group by split, rule, pred),
hc as (select *, sum(pos) over (partition by split, rule order by s desc rows between unbounded preceding and current row) as cp,
                 sum(neg) over (partition by split, rule order by s desc rows between unbounded preceding and current row) as cn from h),
auc as (select split, rule,
   case when sum(pos) > 0 and sum(neg) > 0 then sum(neg * (cp - pos / 2.0)) / (sum(pos) * sum(neg)) end as roc_auc,
   sum(pos * (cp / (cp + cn))) / nullif(sum(pos), 0) as average_precision from hc group by split, rule)
select c.split, c.rule, c.tp, c.fp, c.fn, c.tn,
  round(cast(c.tp + c.tn as double) / (c.tp + c.fp + c.fn + c.tn), 6) as accuracy,
  round(coalesce(2 * c.tp / nullif(cast(2 * c.tp + c.fp + c.fn as double), 0), 0), 6) as f1,
  round(c.brier_score, 6) as brier_score, round(a.roc_auc, 6) as roc_auc, round(a.average_precision, 6) as average_precision
from (select split, rule, cast(sum(case when label = 1 and pred = 1 then 1 else 0 end) as bigint) as tp,
        cast(sum(case when label = 0 and pred = 1 then 1 else 0 end) as bigint) as fp,
        cast(sum(case when label = 1 and pred = 0 then 1 else 0 end) as bigint) as fn,
        cast(sum(case when label = 0 and pred = 0 then 1 else 0 end) as bigint) as tn,
        avg(pow(pred - label, 2)) as brier_score from t group by split, rule) c
join auc a on c.split = a.split and c.rule = a.rule""", "M11,P11")
def q_m11(spark, sf_dir):
    x = _labelled(spark, sf_dir).filter(F.col("split").isin("validation", "test"))
    parts = [x.select("split", F.lit(r).alias("rule"), F.col(lab).alias("label"),
                      le_or_zero(F.col(c), n).alias("pred")) for r, (c, n, lab) in RULES.items()]
    t = parts[0]
    for p in parts[1:]:
        t = t.unionByName(p)
    t = t.withColumn("proba", F.col("pred").cast("double"))
    m = M.classification_metrics(t, ["split", "rule"], "label", "pred", "proba")
    return present(m.select("split", "rule", "tp", "fp", "fn", "tn", "accuracy", "f1", "brier_score",
                            "roc_auc", "average_precision"))


@register("m12_points_baseline", _regression_sql(with_prep(
    f"l as (select *, {SPLIT_CASE} as split from p)",
    "fit as (select grid_position, avg(target_points) as m from l where split = 'train' and grid_position is not null "
    "group by grid_position)",
    "gm as (select avg(target_points) as g from l where split = 'train')",
    "r as (select l.split, l.target_points, greatest(coalesce(fit.m, gm.g), 0.0) as points_pred "
    f"from l left join fit on l.grid_position = fit.grid_position cross join gm where {EVAL.replace('split', 'l.split')})"),
    "points_pred"), "M12,J15,A13")
def q_m12(spark, sf_dir):
    from ..operators.baselines import fit_points_baseline, predict_points_baseline
    lab = _labelled(spark, sf_dir)
    fitted = fit_points_baseline(lab.filter(F.col("split") == "train"), "grid_position", "target_points")
    ev = predict_points_baseline(lab.filter(F.col("split").isin("validation", "test")), fitted,
                                 "grid_position", "points_pred")
    return present(M.regression_metrics(ev, ["split"], "target_points", "points_pred"))


@register("l3_sample_weights", with_prep() + """
select season, cast(case when season <= 1996 then 0.5 when season <= 1998 then 0.8 when season <= 2000 then 1.0
                    else 2.0 end as double) as weight, cast(count(*) as bigint) as n_rows from p group by season""", "L3")
def q_l3(spark, sf_dir):
    p = prepared_panel(spark, sf_dir).withColumn("weight", SPL.season_weight(SP))
    return p.groupBy("season", "weight").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


@register("l2_live_training_rows", with_prep() + f"""
select season, cast(count(*) as bigint) as n_rows from p
where (season between {SP.train_seasons[0]} and {SP.test_season} or (season = {SP.live_season} and round <= 6))
  and target_top10 is not null and target_podium is not null and target_points is not null
group by season""", "L2,P31")
def q_l2(spark, sf_dir):
    x = SPL.live_training_rows(prepared_panel(spark, sf_dir), SP, 6)
    x = SPL.drop_null_targets(x, ["target_top10", "target_podium", "target_points"])
    return x.groupBy("season").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


IMPUTE_COLS = ["driver_avg_finish_last_3", "driver_avg_quali_last_5", "driver_avg_grid_last_5",
               "driver_points_last_5", "driver_dnf_rate_last_10"]


def _impute_sql():
    inner, _ = _driver_form_sql()
    tr = f"f.season between {SP.train_seasons[0]} and {SP.train_seasons[1]}"
    return (f"with f as ({inner}), med as (select " + ", ".join(
        f"median(cast({c} as double)) filter (where {tr}) as {c}" for c in IMPUTE_COLS) + " from f) "
        + " union all ".join(
            f"select '{c}' as feature, round(med.{c}, 6) as median, "
            f"cast(sum(case when f.{c} is null then 1 else 0 end) as bigint) as n_imputed, "
            f"round(avg(coalesce(cast(f.{c} as double), med.{c})), 6) as mean_after "
            f"from f, med where f.season = {SP.validation_season} group by med.{c}" for c in IMPUTE_COLS))


@register("a20_median_impute", _impute_sql(), "A20")
def q_a20(spark, sf_dir):
    x = entity_history(prepared_panel(spark, sf_dir), S)
    train = x.filter(F.col("season").between(*SP.train_seasons))
    val = x.filter(F.col("season") == SP.validation_season)
    imp = SPL.MedianImputer(IMPUTE_COLS).fit(train)
    med = imp.medians
    out = None
    filled = imp.transform(val.select(*IMPUTE_COLS, *[F.col(c).alias(f"raw_{c}") for c in IMPUTE_COLS]))
    for c in IMPUTE_COLS:
        part = filled.agg(F.sum(F.col(f"raw_{c}").isNull().cast("int")).cast("bigint").alias("n_imputed"),
                          F.avg(c).alias("mean_after"))
        part = part.select(F.lit(c).alias("feature"), med.select(c).scalar().alias("median"),
                           "n_imputed", "mean_after")
        out = part if out is None else out.unionByName(part)
    return present(out)


@register("a21_imbalance_ratio", with_prep(f"l as (select *, {SPLIT_CASE} as split from p)") + """
select 'top10' as task, round(greatest(1.0, sum(1 - target_top10) / sum(target_top10)), 6) as pos_weight
from l where split = 'train'
union all
select 'podium', round(greatest(1.0, sum(1 - target_podium) / sum(target_podium)), 6) from l where split = 'train'""",
          "A21")
def q_a21(spark, sf_dir):
    tr = _labelled(spark, sf_dir).filter(F.col("split") == "train")
    a = SPL.imbalance_weight(tr, "target_top10").select(F.lit("top10").alias("task"), "pos_weight")
    b = SPL.imbalance_weight(tr, "target_podium").select(F.lit("podium").alias("task"), "pos_weight")
    return present(a.unionByName(b))


# ----------------------------------------------------------------- U8, U9
METRIC_NAMES = ["accuracy", "precision", "recall", "f1", "brier_score", "roc_auc", "average_precision"]


def _long_metrics(spark, sf_dir) -> DataFrame:
    from ..operators.report import metrics_long
    t = _tasks(_eval_rows(spark, sf_dir))
    m = M.classification_metrics(t, ["split", "task"], "label", "pred", "proba")
    return metrics_long(m.withColumn("model_family", F.lit("grid_rule_score")),
                        ["model_family", "split", "task"], METRIC_NAMES)


U8_SQL = (f"select 'grid_rule_score' as model_family, split, task, metric, value from ({M1_SQL}) m "
          f"unpivot include nulls (value for metric in ({', '.join(METRIC_NAMES)}))")


@register("u8_metrics_long", U8_SQL, "U8")
def q_u8(spark, sf_dir):
    return present(_long_metrics(spark, sf_dir))


@register("u9_metrics_pivot", "select model_family, split, " + ", ".join(
    f"max(case when task = '{t}' and metric = '{m}' then value end) as {t}_{m}"
    for t in ("podium", "top10") for m in METRIC_NAMES) + f" from ({U8_SQL}) u group by model_family, split",
    "U9,L13")
def q_u9(spark, sf_dir):
    from ..operators.report import metrics_wide
    return present(metrics_wide(_long_metrics(spark, sf_dir), ["model_family", "split"], "task", ["podium", "top10"],
                                METRIC_NAMES))
