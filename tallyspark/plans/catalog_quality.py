"""Catalogue: data quality, profiling, reports (A2-A19, A24-A25, J11-J12,
O5-O8, P29, S3, S14, U7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as PR
from ..operators import quality as Q
from ..sources.tables import TESTDATA_TABLES, load_profile, load_tables, read_table
from ..spec import DEFAULT_SPEC, DEFAULT_SPLIT
from .catalog_history import _driver_form_sql
from .panel import base_panel, feature_panel, prepared_panel
from .registry import present, register
from .sqltext import with_prep

S = DEFAULT_SPEC
SP = DEFAULT_SPLIT
LIVE = S.live_season


def _cnt():
    return F.count(F.lit(1)).cast("bigint")


# ------------------------------------------------------------------- A2
@register("a2_duplicate_keys", with_prep() + """
select 'panel_key' as check_name, cast(sum(c) as bigint) as n_rows, cast(count(*) as bigint) as n_keys,
       cast(sum(case when c > 1 then 1 else 0 end) as bigint) as n_duplicated_keys,
       cast(coalesce(sum(c - 1), 0) as bigint) as surplus_rows
from (select count(*) as c from p group by driver_id, season, round) k
union all
select 'lineitem_line_key', cast(sum(c) as bigint), cast(count(*) as bigint),
       cast(sum(case when c > 1 then 1 else 0 end) as bigint), cast(coalesce(sum(c - 1), 0) as bigint)
from (select count(*) as c from lineitem group by l_orderkey, l_linenumber) k""", "A2")
def q_a2(spark, sf_dir):
    a = Q.duplicate_summary(base_panel(spark, sf_dir), S.key, "panel_key")
    b = Q.duplicate_summary(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
                            "lineitem_line_key")
    return a.unionByName(b)


# ------------------------------------------------------------------- A3-A5
@register("a3_rows_per_season",
          with_prep() + "select season, cast(count(*) as bigint) as n_rows from p group by season", "A3")
def q_a3(spark, sf_dir):
    return PR.rows_by(base_panel(spark, sf_dir), ["season"])


@register("a4_completed_rounds",
          with_prep() + "select distinct season, round from p order by season, round", "A4")
def q_a4(spark, sf_dir):
    return PR.distinct_sorted(base_panel(spark, sf_dir), ["season", "round"])


A5_COLS = ["target_top10", "target_podium", "target_points", "quali_position", "grid_position"]


@register("a5_null_counts_by_season",
          with_prep() + "select season, " + ", ".join(
              f"cast(sum(case when {c} is null then 1 else 0 end) as bigint) as {c}_nulls" for c in A5_COLS)
          + " from p group by season", "A5")
def q_a5(spark, sf_dir):
    return PR.null_counts_by(prepared_panel(spark, sf_dir), ["season"], A5_COLS)


# ------------------------------------------------------------------- A6-A8
PROFILE_COLS = ["driver_id", "driver_name", "constructor_id", "circuit_id", "season", "round",
                "position_order", "grid", "quali_position", "status", "points", "grid_position",
                "missing_qualifying", "target_top10", "target_podium", "is_dnf", "grid_vs_quali_delta",
                "grid_to_finish_delta"]


def _profile_sql(cols):
    return " union all ".join(
        f"select '{c}' as column_name, cast(count(*) - count({c}) as bigint) as null_count, "
        f"round(round((count(*) - count({c})) / count(*), 4), 6) as null_rate, "
        f"cast(count(distinct {c}) as bigint) as n_distinct from p" for c in cols)


@register("a6_column_profile", with_prep() + _profile_sql(PROFILE_COLS), "A6")
def q_a6(spark, sf_dir):
    prof = PR.column_profile(prepared_panel(spark, sf_dir), PROFILE_COLS)
    return present(prof.drop("data_type"))


@register("a6_profile_from_sketches", with_prep(f"prof as ({_profile_sql(PROFILE_COLS)})") + """
select column_name, null_count, null_rate, true as distinct_within_3_percent from prof""", "A6,A7,A3")
def q_a6_sketched(spark, sf_dir):
    """The profile merged from one sketch a season, its distinct counts held
    against the exact ones (within 3 %, over three standard errors)."""
    from ..operators import sketches as SK
    p = prepared_panel(spark, sf_dir)
    merged = SK.merged_profile(SK.profile_sketches(p, "season", PROFILE_COLS))
    exact = PR.column_profile(p, PROFILE_COLS).select("column_name", F.col("n_distinct").alias("exact"))
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= 0.03 * F.col("exact")
    return present(merged.join(exact, "column_name").select("column_name", "null_count", "null_rate", near.alias("distinct_within_3_percent")))


@register("a7_null_rate_top", with_prep(f"prof as ({_profile_sql(PROFILE_COLS)})")
          + "select column_name, null_rate from prof order by null_rate desc, column_name limit 25", "A7,O5")
def q_a7(spark, sf_dir):
    prof = PR.column_profile(prepared_panel(spark, sf_dir), PROFILE_COLS)
    return present(PR.top_null_rates(prof, 25).select("column_name", "null_rate"))


A8_COLS = ["driver_avg_finish_last_3", "driver_avg_finish_last_5", "driver_points_last_5",
           "driver_top10_rate_last_5", "driver_dnf_rate_last_10", "driver_avg_quali_last_5"]


def _a8_sql():
    inner, _ = _driver_form_sql()
    return (f"with f as ({inner}) " + " union all ".join(
        f"select '{c}' as feature, round(avg(case when {c} is null then 1.0 else 0.0 end), 6) as null_rate, "
        f"round(stddev_samp(cast({c} as double)), 6) as std from f" for c in A8_COLS))


@register("a8_feature_presence", _a8_sql(), "A8")
def q_a8(spark, sf_dir):
    from ..operators.history import entity_history
    x = entity_history(prepared_panel(spark, sf_dir), S)
    return present(PR.feature_presence(x, A8_COLS))


# ------------------------------------------------------------------- A9-A15
@register("a9_target_rates_by_season", with_prep() + """
select season, round(avg(target_top10), 6) as top10_rate, round(avg(target_podium), 6) as podium_rate,
       round(avg(target_points), 6) as mean_points from p group by season""", "A9")
def q_a9(spark, sf_dir):
    return present(PR.grouped_summary(prepared_panel(spark, sf_dir), ["season"], {
        "top10_rate": F.avg("target_top10"), "podium_rate": F.avg("target_podium"),
        "mean_points": F.avg("target_points")}))


@register("u7_target_rates_long", with_prep() + """
select season, target, round(rate, 6) as rate from (
  select season, 'target_top10' as target, avg(target_top10) as rate from p group by season
  union all select season, 'target_podium', avg(target_podium) from p group by season) t""", "U7")
def q_u7(spark, sf_dir):
    wide = PR.grouped_summary(prepared_panel(spark, sf_dir), ["season"], {
        "target_top10": F.avg("target_top10"), "target_podium": F.avg("target_podium")})
    return present(PR.unpivot_long(wide, ["season"], ["target_top10", "target_podium"], "target", "rate"))


@register("a10_points_by_group_top15", with_prep() + """
select constructor_id, cast(sum(points) as bigint) as total_points from p
where season between 1996 and 2000 group by constructor_id
order by total_points desc, constructor_id limit 15""", "A10,O5")
def q_a10g(spark, sf_dir):
    p = prepared_panel(spark, sf_dir).filter(F.col("season").between(1996, 2000))
    return PR.grouped_summary(p, ["constructor_id"], {"total_points": F.sum("points").cast("bigint")},
                              [F.desc("total_points"), F.asc("constructor_id")], 15)


@register("a10_points_by_entity_top20", with_prep() + """
select driver_id, driver_name, cast(sum(points) as bigint) as total_points from p
where season between 1996 and 2000 group by driver_id, driver_name
order by total_points desc, driver_id limit 20""", "A10,O5")
def q_a10e(spark, sf_dir):
    p = prepared_panel(spark, sf_dir).filter(F.col("season").between(1996, 2000))
    return PR.grouped_summary(p, ["driver_id", "driver_name"], {"total_points": F.sum("points").cast("bigint")},
                              [F.desc("total_points"), F.asc("driver_id")], 20)


@register("a11_live_group_summary", with_prep() + f"""
select constructor_id, cast(sum(points) as bigint) as total_points, round(avg(target_top10), 6) as top10_rate,
       cast(sum(target_podium) as bigint) as podiums from p where season = {LIVE} group by constructor_id""", "A11")
def q_a11(spark, sf_dir):
    p = prepared_panel(spark, sf_dir).filter(F.col("season") == LIVE)
    return present(PR.grouped_summary(p, ["constructor_id"], {
        "total_points": F.sum("points").cast("bigint"), "top10_rate": F.avg("target_top10"),
        "podiums": F.sum("target_podium").cast("bigint")}))


@register("a12_live_entity_summary", with_prep() + f"""
select driver_id, cast(sum(points) as bigint) as total_points, round(avg(target_top10), 6) as top10_rate,
       cast(sum(target_podium) as bigint) as podiums, round(avg(position_order), 6) as avg_finish
from p where season = {LIVE} group by driver_id order by total_points desc, driver_id limit 20""", "A12,O5")
def q_a12(spark, sf_dir):
    p = prepared_panel(spark, sf_dir).filter(F.col("season") == LIVE)
    return present(PR.grouped_summary(p, ["driver_id"], {
        "total_points": F.sum("points").cast("bigint"), "top10_rate": F.avg("target_top10"),
        "podiums": F.sum("target_podium").cast("bigint"), "avg_finish": F.avg("position_order")},
        [F.desc("total_points"), F.asc("driver_id")], 20))


@register("a13_points_by_grid", with_prep() + """
select grid_position, round(avg(target_points), 6) as mean_points, cast(count(*) as bigint) as n_rows
from p where grid_position is not null group by grid_position""", "A13")
def q_a13(spark, sf_dir):
    p = prepared_panel(spark, sf_dir).filter(F.col("grid_position").isNotNull())
    return present(PR.grouped_summary(p, ["grid_position"], {"mean_points": F.avg("target_points"),
                                                              "n_rows": _cnt()}))


@register("a14_venue_profile", with_prep() + """
select circuit_id, round(avg(points), 6) as avg_points, round(avg(target_podium), 6) as podium_rate,
       round(avg(target_top10), 6) as top10_rate, cast(count(*) as bigint) as n_rows
from p group by circuit_id order by avg_points desc, circuit_id limit 15""", "A14,O5")
def q_a14(spark, sf_dir):
    return present(PR.grouped_summary(prepared_panel(spark, sf_dir), ["circuit_id"], {
        "avg_points": F.avg("points"), "podium_rate": F.avg("target_podium"),
        "top10_rate": F.avg("target_top10"), "n_rows": _cnt()},
        [F.desc("avg_points"), F.asc("circuit_id")], 15))


SPLIT_CASE = (f"case when season between {SP.train_seasons[0]} and {SP.train_seasons[1]} then 'train' "
              f"when season = {SP.validation_season} then 'validation' when season = {SP.test_season} then 'test' "
              f"when season = {SP.live_season} then 'live' end")


@register("a15_split_summary", with_prep() + f"""
select split, cast(count(*) as bigint) as n_rows, min(season) as min_season, max(season) as max_season,
       cast(count(distinct season) as bigint) as n_seasons, round(avg(target_top10), 6) as top10_rate,
       round(avg(target_podium), 6) as podium_rate
from (select *, {SPLIT_CASE} as split from p) t where split is not null group by split""", "A15,L1")
def q_a15(spark, sf_dir):
    from ..operators.split import split_label
    p = split_label(prepared_panel(spark, sf_dir), SP).filter(F.col("split").isNotNull())
    return present(PR.grouped_summary(p, ["split"], {
        "n_rows": _cnt(), "min_season": F.min("season"), "max_season": F.max("season"),
        "n_seasons": F.count_distinct("season").cast("bigint"), "top10_rate": F.avg("target_top10"),
        "podium_rate": F.avg("target_podium")}))


# ------------------------------------------------------------------- A18-A19
CORR_COLS = ["grid_position", "quali_position", "position_order", "target_points", "is_dnf"]


def _corr_sql():
    parts = []
    for i, a in enumerate(CORR_COLS):
        for j, b in enumerate(CORR_COLS):
            parts.append(f"select '{a}' as col_a, '{b}' as col_b, round(corr("
                         f"cast({a} as double), cast({b} as double)), 6) as corr from p "
                         f"where {a} is not null and {b} is not null")
    return with_prep() + " union all ".join(parts)


@register("a18_correlation", _corr_sql(), "A18")
def q_a18(spark, sf_dir):
    return present(PR.pairwise_correlation(prepared_panel(spark, sf_dir), CORR_COLS))


@register("a19_quartiles_by_class", with_prep() + """
select target_top10, quantile_cont(cast(grid_position as double), 0.25) as q25,
       quantile_cont(cast(grid_position as double), 0.5) as q50,
       quantile_cont(cast(grid_position as double), 0.75) as q75
from p where grid_position is not null group by target_top10""", "A19")
def q_a19q(spark, sf_dir):
    return present(PR.quartiles_by(prepared_panel(spark, sf_dir), ["target_top10"], "grid_position"))


@register("a19_histogram", with_prep() + """
select bin, round(lo + bin * (hi - lo) / 20, 6) as bin_start, cast(count(*) as bigint) as n from (
  select case when hi - lo = 0 then 0
              else cast(least(floor((v - lo) / (hi - lo) * 20), 19) as int) end as bin, lo, hi
  from (select cast(position_order as double) as v from p where position_order is not null) x,
       (select min(cast(position_order as double)) as lo, max(cast(position_order as double)) as hi from p) r
) t group by bin, lo, hi""", "A19")
def q_a19h(spark, sf_dir):
    return present(PR.histogram(prepared_panel(spark, sf_dir), "position_order", 20))


# ------------------------------------------------------------------- J11, J12, S14
def _official_points(df):
    """'Official' standings: reconstructed totals plus 3 for entities with
    an even key in the last two seasons (a deliberate disagreement)."""
    tot = df.groupBy("season", "driver_name", "driver_id").agg(F.sum("event_points").alias("pts"))
    bump = F.when((F.col("driver_id") % 2 == 0) & (F.col("season") >= LIVE - 1), F.lit(3)).otherwise(F.lit(0))
    return tot.select("season", "driver_name", (F.col("pts") + bump).cast("double").alias("official_points"))


@register("j11_standings_reconciliation", with_prep() + f"""
select coalesce(r.season, o.season) as season, coalesce(r.driver_name, o.driver_name) as driver_name,
       r.reconstructed_event_points, o.official_points,
       r.reconstructed_event_points - o.official_points as difference
from (select season, driver_name, cast(sum(event_points) as double) as reconstructed_event_points
      from p group by season, driver_name) r
full outer join (select season, driver_name, cast(sum(event_points) + case when driver_id % 2 = 0
                   and season >= {LIVE - 1} then 3 else 0 end as double) as official_points
                 from p group by season, driver_name, driver_id) o
  on r.season = o.season and r.driver_name = o.driver_name
where abs(coalesce(r.reconstructed_event_points - o.official_points, 0)) > 0.01""", "J11")
def q_j11(spark, sf_dir):
    p = prepared_panel(spark, sf_dir)
    rec = p.groupBy("season", "driver_name").agg(
        F.sum("event_points").cast("double").alias("reconstructed_event_points"))
    return present(Q.reconcile(rec, _official_points(p), ["season", "driver_name"],
                               "reconstructed_event_points", "official_points"))


def _schedule(p):
    """Live-season calendar: every month of the live season, derived from the
    seasons present in the panel."""
    seasons = p.select("season").where(F.col("season") == LIVE).distinct()
    return seasons.select("season", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("round"))


@register("j12_schedule_coverage", with_prep() + f"""
select s.season, s.round, case when c.round is null then 0 else 1 end as completed
from (select distinct season, cast(unnest(range(1, 13)) as int) as round from p where season = {LIVE}) s
left join (select distinct season, round from p) c on s.season = c.season and s.round = c.round""", "J12")
def q_j12(spark, sf_dir):
    p = base_panel(spark, sf_dir)
    return Q.coverage_flag(_schedule(p), p, ["season", "round"]).select(
        "season", "round", F.col("completed").cast("int").alias("completed"))


@register("j12_absent_rounds", with_prep() + f"""
select s.season, s.round
from (select distinct season, cast(unnest(range(1, 13)) as int) as round from p where season = {LIVE}) s
where not exists (select 1 from p where p.season = s.season and p.round = s.round)""", "J12,J9")
def q_j12b(spark, sf_dir):
    p = base_panel(spark, sf_dir)
    return Q.absent_rows(_schedule(p), p, ["season", "round"]).select("season", "round")


@register("s14_snapshot_coverage", with_prep() + """
select season, kind, cast(count(*) as bigint) as n_rows, cast(count(distinct round) as bigint) as n_rounds from (
  select season, round, 'results' as kind from p
  union all select season, round, 'qualifying' from p where quali_position is not null
  union all select distinct season, round, 'schedule' from p) u
group by season, kind""", "S14")
def q_s14(spark, sf_dir):
    p = base_panel(spark, sf_dir)
    return Q.snapshot_coverage({
        "results": p, "qualifying": p.filter(F.col("quali_position").isNotNull()),
        "schedule": p.select("season", "round").distinct()}, "season", "round")


# ------------------------------------------------------------------- O6-O8, P29
SAMPLE_KEY_SQL = "((driver_id * 7919 + event_seq * 104729) % 1000003)"


@register("o6_deterministic_sample", with_prep() + f"""
select driver_id, season, round, position_order from p
order by {SAMPLE_KEY_SQL}, driver_id, season, round limit 2500""", "O6")
def q_o6(spark, sf_dir):
    p = base_panel(spark, sf_dir)
    key = F.struct((F.col("driver_id") * 7919 + F.col("event_seq") * 104729) % 1000003,
                   F.col("driver_id"), F.col("season"), F.col("round"))
    return PR.deterministic_sample(p, 2500, key).select("driver_id", "season", "round", "position_order")


@register("o7_most_active_timeline", with_prep(
    "c as (select driver_id, count(*) as n from p where season between 1996 and 1999 group by driver_id)",
    "best as (select driver_id from c order by n desc, driver_id limit 1)") + """
select p.driver_id, p.season, p.round, p.position_order, p.points from p join best using (driver_id)
where p.season between 1996 and 1999""", "O7")
def q_o7(spark, sf_dir):
    p = base_panel(spark, sf_dir)
    return PR.most_active_timeline(p, "driver_id", ["season", "round"],
                                   F.col("season").between(1996, 1999)).select(
        "driver_id", "season", "round", "position_order", "points")


@register("o8_best_row_per_name", with_prep() + """
select driver_name, season, round, position_order from (
  select *, row_number() over (partition by driver_name order by position_order, event_seq) as rn from p) t
where rn = 1""", "O8,W9")
def q_o8(spark, sf_dir):
    p = base_panel(spark, sf_dir).select("driver_name", "season", "round", "position_order", "event_seq")
    out = PR.first_per_key(p, ["driver_name"], [F.col("position_order"), F.col("event_seq")])
    return out.select("driver_name", "season", "round", "position_order")


@register("p29_predicate_catalogue", with_prep() + """
select driver_id, season, round from p
where season between 1996 and 2000 and round in (1, 4, 7, 10) and quali_position is not null
  and grid_position <= 20 and position_order >= 2 and starts_with(driver_name, 'Supplier#')
  and regexp_matches(status, 'lap|finish', 'i') and constructor_id = constructor_id""", "P29")
def q_p29(spark, sf_dir):
    p = prepared_panel(spark, sf_dir)
    return p.filter(F.col("season").between(1996, 2000) & F.col("round").isin(1, 4, 7, 10)
                    & F.col("quali_position").isNotNull() & (F.col("grid_position") <= 20)
                    & (F.col("position_order") >= 2) & F.col("driver_name").startswith("Supplier#")
                    & F.col("status").rlike("(?i)lap|finish")
                    & (F.col("constructor_id") == F.col("constructor_id"))).select("driver_id", "season", "round")


# ------------------------------------------------------------------- A24, A25
@register("a24_leakage_check", with_prep() + f"""
select cast(count(*) as bigint) as n_entities,
       cast(sum(case when rb <> 0 or h is not null then 1 else 0 end) as bigint) as n_violations
from (select row_number() over (partition by driver_id order by event_seq) - 1 as rb,
             avg(position_order) over (partition by driver_id order by event_seq rows between 5 preceding and 1 preceding) as h,
             row_number() over (partition by driver_id order by event_seq) as rn from p) t where rn = 1""", "A24")
def q_a24(spark, sf_dir):
    return Q.leakage_report(feature_panel(spark, sf_dir), "driver_id", "event_seq")


@register("a25_missing_targets_closed", with_prep() + f"""
select driver_id, season, round from p
where season < {LIVE} and (target_top10 is null or target_podium is null or target_points is null)""", "A25")
def q_a25(spark, sf_dir):
    return Q.missing_targets(prepared_panel(spark, sf_dir), "season", LIVE,
                             ["target_top10", "target_podium", "target_points"]).select("driver_id", "season", "round")


# ------------------------------------------------------------------- S3
def _s3_sql():
    """Profiles every table without naming a column: DuckDB expands them."""
    return " union all ".join(f"""select * from (
  select '{t}' as table_name, n_rows, cast(count(*) over () as int) as n_cols, column_name, round(null_rate, 6) as null_rate,
    cast(row_number() over (order by null_rate desc, column_name) as int) as null_rank
  from (select name as column_name, avg(cast(gone as double)) as null_rate, cast(count(*) as bigint) as n_rows
        from (unpivot (select cast(columns(*) is null as int) as "\\0" from {t}) on columns(*) into name name value gone)
        group by name) x) where null_rank <= 3""" for t in TESTDATA_TABLES)


@register("s3_load_profile", _s3_sql(), "S2,S3")
def q_s3(spark, sf_dir):
    tables = load_tables(spark, sf_dir, TESTDATA_TABLES)
    return present(load_profile(tables, 3).select(
        "table_name", F.col("n_rows").cast("bigint").alias("n_rows"), "n_cols", "column_name", "null_rate",
        F.col("null_rank").cast("int").alias("null_rank")))
