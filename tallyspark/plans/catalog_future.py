"""Catalogue: as-of future rows and top-N prediction tables (J13, J14, W8, W10,
W11, W-AS, P19-P28, P30, O2, O3, U2, A17, A22, A23, L10-L11).

Cut: live season, before round 7.  Rounds 7.. of the live season exist in the
panel, so the future rows can be checked against a back-test oracle.
Scores are deterministic functions of the as-of features (no model needed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import confidence_label, rank_score, threshold_class
from ..operators import future as FU
from ..operators import quality as Q
from ..operators import rank as RK
from ..spec import DEFAULT_SPEC
from .panel import prepared_panel
from .registry import present, register
from .sqltext import with_prep

S = DEFAULT_SPEC
LIVE = S.live_season
CUT = 7

FUTURE_COLS = ["driver_id", "season", "round", "constructor_id", "driver_races_before", "driver_avg_finish_last_5",
               "driver_points_last_3", "driver_points_before_season",
               "races_completed_current_season_before_driver", "constructor_points_last_3",
               "constructor_points_before_season", "teammate_recent_points_last_5",
               "driver_strength_rank_before", "driver_avg_finish_on_circuit_before",
               "constructor_avg_finish_on_circuit_before", "circuit_dnf_rate_before", "prediction_mode"]


def future_rows(spark, sf_dir) -> DataFrame:
    """Future inputs for the cut, written once per session (a stage of the
    pipeline, like the base panel)."""
    import os
    from .panel import _stage

    def build():
        p = prepared_panel(spark, sf_dir)
        return FU.future_feature_rows(p, FU.event_schedule(p, S), S, LIVE, CUT)
    return _stage(spark, ("future", os.path.abspath(sf_dir), LIVE, CUT), build)


def future_ctes(cut: int = CUT, only_round: int | None = None) -> list[str]:
    tgt = f"round = {only_round}" if only_round is not None else f"round >= {cut}"
    return [c.replace("__CUT__", str(cut)).replace("__TGT__", tgt) for c in _FUTURE_CTES]


_FUTURE_CTES = [
    f"h as (select * from p where season < {LIVE} or (season = {LIVE} and round < __CUT__))",
    f"ent as (select driver_id, constructor_id from h where event_seq = (select max(event_seq) from h where season = {LIVE}))",
    f"tg as (select distinct season, round, event_seq, circuit_id from p where season = {LIVE} and __TGT__)",
    "hr as (select *, row_number() over (partition by driver_id order by event_seq desc) as rn from h)",
    f"""d as (select driver_id, cast(count(*) as int) as driver_races_before,
        avg(case when rn <= 5 then position_order end) as driver_avg_finish_last_5,
        cast(sum(case when rn <= 3 then grand_prix_points end) as bigint) as driver_points_last_3,
        sum(case when rn <= 5 then grand_prix_points end) as d5,
        avg(case when rn <= 10 then target_top10 end) as top10_rate_10,
        avg(case when rn <= 10 then target_podium end) as podium_rate_10,
        sum(case when rn <= 5 then grand_prix_points end) as pts5,
        cast(coalesce(sum(case when season = {LIVE} then grand_prix_points end), 0) as bigint) as driver_points_before_season,
        cast(count(case when season = {LIVE} then 1 end) as int) as races_completed_current_season_before_driver
      from hr group by driver_id)""",
    "ge as (select constructor_id, event_seq, season, sum(grand_prix_points) as pts from h group by constructor_id, event_seq, season)",
    f"""g as (select constructor_id, cast(sum(case when rn <= 3 then pts end) as bigint) as constructor_points_last_3,
        cast(coalesce(sum(case when season = {LIVE} then pts end), 0) as bigint) as constructor_points_before_season
      from (select *, row_number() over (partition by constructor_id order by event_seq desc) as rn from ge) x
      group by constructor_id)""",
    """snap as (select ent.driver_id, ent.constructor_id, d.*, g.constructor_points_last_3, g.constructor_points_before_season,
        cast(case when count(d.d5) over (partition by ent.constructor_id) > 1
             then sum(d.d5) over (partition by ent.constructor_id) - d.d5 end as bigint) as teammate_recent_points_last_5,
        cast(dense_rank() over (order by d.driver_points_before_season desc) as int) as driver_strength_rank_before
      from ent join d using (driver_id) left join g using (constructor_id))""",
    """rows as (select s.driver_id, tg.season, tg.round, s.constructor_id, s.driver_races_before,
        s.driver_avg_finish_last_5, s.driver_points_last_3, s.driver_points_before_season,
        s.races_completed_current_season_before_driver, s.constructor_points_last_3, s.constructor_points_before_season,
        s.teammate_recent_points_last_5, s.driver_strength_rank_before, s.top10_rate_10, s.podium_rate_10, s.pts5,
        (select avg(position_order) from h where h.driver_id = s.driver_id and h.circuit_id = tg.circuit_id)
          as driver_avg_finish_on_circuit_before,
        (select avg(position_order) from h where h.constructor_id = s.constructor_id and h.circuit_id = tg.circuit_id)
          as constructor_avg_finish_on_circuit_before,
        (select avg(is_dnf) from h where h.circuit_id = tg.circuit_id) as circuit_dnf_rate_before,
        'PRE-QUALI' as prediction_mode
      from snap s, tg)""",
]
FUTURE_CTES = future_ctes()


@register("wa_future_feature_rows", with_prep(*FUTURE_CTES) + """
select driver_id, season, round, constructor_id, driver_races_before, round(driver_avg_finish_last_5, 6) as driver_avg_finish_last_5,
  driver_points_last_3, driver_points_before_season, races_completed_current_season_before_driver,
  constructor_points_last_3, constructor_points_before_season, teammate_recent_points_last_5, driver_strength_rank_before,
  round(driver_avg_finish_on_circuit_before, 6) as driver_avg_finish_on_circuit_before,
  round(constructor_avg_finish_on_circuit_before, 6) as constructor_avg_finish_on_circuit_before,
  round(circuit_dnf_rate_before, 6) as circuit_dnf_rate_before, prediction_mode
from rows""", "W-AS,J13,J14,W8,W10,P19,P20,P28,P30,U2")
def q_future(spark, sf_dir):
    return present(future_rows(spark, sf_dir), FUTURE_COLS)


def _scored(spark, sf_dir) -> DataFrame:
    """L10 with a deterministic scorer: probabilities from recent rates,
    expected points from recent points, P22-P25 on top."""
    x = future_rows(spark, sf_dir).withColumns({
        "proba_top10": F.coalesce(F.col("driver_top10_rate_last_10"), F.lit(0.0)),
        "proba_podium": F.coalesce(F.col("driver_podium_rate_last_10"), F.lit(0.0)),
        "expected_points": F.greatest(F.coalesce(F.col("driver_points_last_5"), F.lit(0)) / 5.0, F.lit(0.0)),
    })
    x = x.withColumns({
        "race_rank_score": rank_score("expected_points", "proba_podium", "proba_top10"),
        "predicted_top10": threshold_class("proba_top10", 0.5),
        "predicted_podium": threshold_class("proba_podium", 0.5),
    })
    return x.withColumn("confidence", confidence_label("proba_top10", "race_rank_score", "prediction_mode"))


SCORED_CTE = """sc as (select driver_id, season, round, prediction_mode, coalesce(top10_rate_10, 0.0) as proba_top10,
    coalesce(podium_rate_10, 0.0) as proba_podium, greatest(coalesce(pts5, 0) / 5.0, 0.0) as expected_points
  from rows)"""
SCORED2_CTE = """sc2 as (select *, expected_points * 1.0 + proba_podium * 3.0 + proba_top10 as race_rank_score,
    cast(proba_top10 >= 0.5 as int) as predicted_top10, cast(proba_podium >= 0.5 as int) as predicted_podium,
    case when (case when upper(prediction_mode) like 'POST%' then 75 else 55 end
               + case when proba_top10 < 0.25 or proba_top10 > 0.75 then 10 else 0 end) >= 80 then 'High'
         when (case when upper(prediction_mode) like 'POST%' then 75 else 55 end
               + case when proba_top10 < 0.25 or proba_top10 > 0.75 then 10 else 0 end) >= 60 then 'Medium'
         else 'Low' end as confidence
  from sc)"""
TOPN_CTE = """topn as (select *, cast(row_number() over (partition by season, round order by race_rank_score desc,
      expected_points desc, proba_podium desc, proba_top10 desc, driver_id) as int) as predicted_rank from sc2
  qualify predicted_rank <= 10)"""
TOP_COLS = ["predicted_rank", "season", "round", "driver_id", "proba_top10", "proba_podium", "expected_points",
            "race_rank_score", "predicted_top10", "predicted_podium", "confidence", "prediction_mode"]


def top_table(spark, sf_dir) -> DataFrame:
    return RK.predict_top_n(_scored(spark, sf_dir).select(*TOP_COLS[1:]), ["season", "round"], "driver_id", 10)


@register("o3_top_n_predictions", with_prep(*FUTURE_CTES, SCORED_CTE, SCORED2_CTE, TOPN_CTE)
          + "select " + ", ".join(f"round({c}, 6) as {c}" if c in ("proba_top10", "proba_podium", "expected_points",
                                                                    "race_rank_score") else c for c in TOP_COLS)
          + " from topn", "O3,O2,W11,P22,P23,P24,P25,P27")
def q_topn(spark, sf_dir):
    return present(top_table(spark, sf_dir).select(*TOP_COLS))


@register("a22_confidence_mode", with_prep(*FUTURE_CTES, SCORED_CTE, SCORED2_CTE, TOPN_CTE) + """
select season, round, confidence as confidence_mode from (
  select season, round, confidence, row_number() over (partition by season, round order by count(*) desc, confidence) as r
  from topn group by season, round, confidence) t where r = 1""", "A22")
def q_a22(spark, sf_dir):
    return RK.label_mode(top_table(spark, sf_dir), ["season", "round"], "confidence")


@register("a23_prediction_contract", with_prep(*FUTURE_CTES, SCORED_CTE, SCORED2_CTE, TOPN_CTE) + """
select season, round, count(*) = 10 as row_count_ok, count(distinct driver_id) = count(*) as unique_ok,
  bool_and(proba_top10 between 0 and 1 and proba_podium between 0 and 1) as probabilities_ok,
  bool_and(expected_points >= 0) as non_negative_ok, bool_and(prev is null or race_rank_score <= prev) as order_ok,
  bool_and(prediction_mode in ('PRE-QUALI', 'POST-QUALI')) as mode_ok
from (select *, lag(race_rank_score) over (partition by season, round order by predicted_rank) as prev from topn) t
group by season, round""", "A23")
def q_a23(spark, sf_dir):
    return Q.contract_checks(top_table(spark, sf_dir), 10, "driver_id", ["proba_top10", "proba_podium"],
                             ["expected_points"], "race_rank_score", "predicted_rank", "prediction_mode",
                             ["PRE-QUALI", "POST-QUALI"], by=["season", "round"])


@register("a17_future_rounds_by_mode", with_prep(*FUTURE_CTES) + """
select season, round, prediction_mode, cast(count(*) as bigint) as n_rows from rows group by season, round, prediction_mode""",
          "A17")
def q_a17(spark, sf_dir):
    return future_rows(spark, sf_dir).groupBy("season", "round", "prediction_mode").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"))


@register("p21_missing_inputs", with_prep(*FUTURE_CTES) + """
select driver_id, season, round from rows""", "P21")
def q_p21(spark, sf_dir):
    ready, missing = FU.split_ready(future_rows(spark, sf_dir), S)
    return missing.select("driver_id", "season", "round")


@register("j14_backtest_windows", with_prep(
    f"t as (select driver_id, season, round, event_seq from p where season = {LIVE} and round >= {CUT})",
    """j as (select t.driver_id, t.season, t.round, h.event_seq as hs, h.position_order, h.grand_prix_points,
           row_number() over (partition by t.driver_id, t.season, t.round order by h.event_seq desc) as rn
         from t left join p h on h.driver_id = t.driver_id and h.event_seq < t.event_seq)""") + """
select driver_id, season, round, cast(count(hs) as int) as driver_races_before,
  round(avg(case when rn <= 3 then position_order end), 6) as driver_avg_finish_last_3,
  cast(sum(case when rn <= 3 then grand_prix_points end) as bigint) as driver_points_last_3,
  round(avg(case when rn <= 5 then position_order end), 6) as driver_avg_finish_last_5,
  cast(sum(case when rn <= 5 then grand_prix_points end) as bigint) as driver_points_last_5
from j group by driver_id, season, round""", "J14")
def q_j14(spark, sf_dir):
    p = prepared_panel(spark, sf_dir)
    t = p.filter((F.col("season") == LIVE) & (F.col("round") >= CUT))
    out = FU.backtest_entity_windows(p, t, S, (3, 5))
    return present(out.select("driver_id", "season", "round", "driver_races_before", "driver_avg_finish_last_3",
                              F.col("driver_points_last_3").cast("bigint").alias("driver_points_last_3"),
                              "driver_avg_finish_last_5",
                              F.col("driver_points_last_5").cast("bigint").alias("driver_points_last_5")))


@register("a16_round_prediction_summary", with_prep(*FUTURE_CTES, SCORED_CTE) + """
select season, round, cast(count(*) as bigint) as n_rows, round(avg(proba_top10), 6) as mean_proba_top10,
  round(avg(proba_podium), 6) as mean_proba_podium, round(sum(expected_points), 6) as total_expected_points
from sc group by season, round""", "A16")
def q_a16(spark, sf_dir):
    return present(_scored(spark, sf_dir).groupBy("season", "round").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"), F.avg("proba_top10").alias("mean_proba_top10"),
        F.avg("proba_podium").alias("mean_proba_podium"), F.sum("expected_points").alias("total_expected_points")))


@register("p27_display_table", with_prep(*FUTURE_CTES, SCORED_CTE, SCORED2_CTE, TOPN_CTE) + """
select predicted_rank, season, round, driver_id, printf('%.1f%%', round(proba_top10 * 100, 1)) as p_top10,
  printf('%.1f%%', round(proba_podium * 100, 1)) as p_podium, round(expected_points, 2) as expected_points
from topn""", "P27")
def q_p27(spark, sf_dir):
    t = top_table(spark, sf_dir)
    return present(t.select("predicted_rank", "season", "round", "driver_id",
                            F.format_string("%.1f%%", F.round(F.col("proba_top10") * 100, 1)).alias("p_top10"),
                            F.format_string("%.1f%%", F.round(F.col("proba_podium") * 100, 1)).alias("p_podium"),
                            F.round("expected_points", 2).alias("expected_points")))


SELECTED = 9


@register("l11_predict_selected_event", with_prep(*future_ctes(SELECTED, SELECTED), SCORED_CTE, SCORED2_CTE, TOPN_CTE)
          + """, cm as (select season, round, confidence as confidence_mode from (
    select season, round, confidence, row_number() over (partition by season, round order by count(*) desc, confidence) as r
    from topn group by season, round, confidence) t where r = 1)
select t.predicted_rank, t.season, t.round, t.driver_id, round(t.proba_top10, 6) as proba_top10,
  round(t.proba_podium, 6) as proba_podium, round(t.expected_points, 6) as expected_points,
  round(t.race_rank_score, 6) as race_rank_score, t.confidence, t.prediction_mode, cm.confidence_mode
from topn t join cm using (season, round)""".replace("\n, cm as", ", cm as"), "L11,E3,A22,P25,P18")
def q_l11(spark, sf_dir):
    from .predict import predict_event
    p = prepared_panel(spark, sf_dir)
    out = predict_event(p, FU.event_schedule(p, S), S, LIVE, SELECTED)
    return present(out.select("predicted_rank", "season", "round", "driver_id", "proba_top10", "proba_podium",
                              "expected_points", "race_rank_score", "confidence", "prediction_mode",
                              "confidence_mode"))


@register("p32_future_with_quali_feed", with_prep(*FUTURE_CTES) + """,
fq as (select r.driver_id, r.season, r.round, q.quali_position from rows r
       left join p q on q.driver_id = r.driver_id and q.season = r.season and q.round = r.round)
select driver_id, season, round, quali_position, quali_position as grid_position,
  cast(quali_position is null as int) as missing_qualifying,
  case when bool_and(quali_position is not null) over (partition by season, round) then 'POST-QUALI'
       else 'PRE-QUALI' end as prediction_mode
from fq""", "P32,D4,P28")
def q_p32(spark, sf_dir):
    p = prepared_panel(spark, sf_dir)
    feed = p.filter((F.col("season") == LIVE) & (F.col("round") >= CUT)).select(
        "season", "round", "driver_id", "quali_position")
    rows = FU.future_feature_rows(p, FU.event_schedule(p, S), S, LIVE, CUT, quali_feed=feed, grid_from_quali=True)
    return rows.select("driver_id", "season", "round", "quali_position", "grid_position", "missing_qualifying",
                       "prediction_mode")
