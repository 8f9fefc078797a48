"""Catalogue: base panel, same-row columns and history features (P, W, F)."""

from __future__ import annotations

from ..operators import history as H
from ..spec import DEFAULT_SPEC
from ..sources.fixture import PANEL_SQL
from .panel import base_panel, feature_panel, prepared_panel
from .registry import present, register
from .sqltext import rounded, with_prep

S = DEFAULT_SPEC
KEY = ["driver_id", "season", "round"]
ROWS_PRIOR = "rows between unbounded preceding and 1 preceding"
RANGE_PRIOR = "range between unbounded preceding and 1 preceding"


def _rows(n: int) -> str:
    return f"rows between {n} preceding and 1 preceding"


def _over(part: str, frame: str, order: str = "event_seq") -> str:
    return f"over (partition by {part} order by {order} {frame})"


# ---------------------------------------------------------------- base panel
@register("fx_supplier_month_panel",
          f"select * from ({PANEL_SQL}) t",
          "P1,J1,P3")
def q_panel(spark, sf_dir):
    return base_panel(spark, sf_dir)


PREPARED_COLS = [
    "driver_id", "season", "round", "missing_qualifying", "grid_position", "grand_prix_points",
    "sprint_points", "event_points", "sprint_weekend_flag", "target_top10", "target_podium",
    "target_points", "grid_vs_quali_delta", "qualified_top3", "qualified_top10", "started_top3",
    "started_top10", "race_round", "is_2001_regulation", "is_dnf", "grid_to_finish_delta",
]


@register("p4_prepared_panel",
          with_prep() + f"select {', '.join(PREPARED_COLS)} from p",
          "P4,P5,P6,P7,P8,P9,P10,P11,P12,P13")
def q_prepared(spark, sf_dir):
    return present(prepared_panel(spark, sf_dir), PREPARED_COLS)


# ------------------------------------------------------------- driver windows
def _driver_form_sql() -> str:
    sel = ["driver_id", "season", "round",
           f"cast(row_number() over (partition by driver_id order by event_seq) - 1 as int) as driver_races_before"]
    dbl = []
    for n in S.windows:
        sel.append(f"avg(position_order) {_over('driver_id', _rows(n))} as driver_avg_finish_last_{n}")
        dbl.append(f"driver_avg_finish_last_{n}")
        sel.append(f"cast(sum(grand_prix_points) {_over('driver_id', _rows(n))} as bigint) as driver_points_last_{n}")
        sel.append(f"cast(sum(event_points) {_over('driver_id', _rows(n))} as bigint) as driver_event_points_last_{n}")
        if n in S.rate_windows:
            for c, name in (("target_top10", "top10_rate"), ("target_podium", "podium_rate"), ("is_dnf", "dnf_rate")):
                sel.append(f"avg({c}) {_over('driver_id', _rows(n))} as driver_{name}_last_{n}")
                dbl.append(f"driver_{name}_last_{n}")
    sel.append(f"avg(grid_position) {_over('driver_id', _rows(5))} as driver_avg_grid_last_5")
    sel.append(f"avg(quali_position) {_over('driver_id', _rows(5))} as driver_avg_quali_last_5")
    dbl += ["driver_avg_grid_last_5", "driver_avg_quali_last_5"]
    inner = with_prep() + "select " + ",\n  ".join(sel) + " from p"
    return inner, dbl


DRIVER_FORM_COLS = ["driver_races_before"] + [
    c for n in S.windows for c in (
        [f"driver_avg_finish_last_{n}", f"driver_points_last_{n}", f"driver_event_points_last_{n}"]
        + ([f"driver_top10_rate_last_{n}", f"driver_podium_rate_last_{n}", f"driver_dnf_rate_last_{n}"]
           if n in S.rate_windows else []))
] + ["driver_avg_grid_last_5", "driver_avg_quali_last_5"]


def _wrap(inner_dbl, cols):
    inner, dbl = inner_dbl
    keep = [c for c in cols if c not in dbl]
    return f"select {', '.join(keep)}{', ' if dbl else ''}{rounded(dbl)} from ({inner}) t"


@register("w1_driver_form", _wrap(_driver_form_sql(), KEY + DRIVER_FORM_COLS),
          "W1,W3,F1,F2,F3,F4,F5,F6")
def q_driver_form(spark, sf_dir):
    x = H.entity_history(prepared_panel(spark, sf_dir), S)
    return present(x, KEY + DRIVER_FORM_COLS)


# --------------------------------------------------------------- season to date
def _tot(x, part, compat):
    run = f"coalesce(sum({x}) {_over(part, ROWS_PRIOR)}, 0)"
    if compat:
        run = f"case when lag({x}) over (partition by {part} order by event_seq) is null then 0 else {run} end"
    return f"cast({run} as bigint)"


def _std_ctes(compat: bool) -> list[str]:
    ge = ("ge as (select season, round, event_seq, constructor_id, sum(grand_prix_points) as constructor_points, "
          "sum(event_points) as constructor_event_points from p where constructor_id is not null "
          "group by season, round, event_seq, constructor_id)")
    gs = ("gs as (select season, round, constructor_id, "
          f"{_tot('constructor_points', 'season, constructor_id', compat)} as constructor_points_before_season, "
          f"{_tot('constructor_event_points', 'season, constructor_id', compat)} as constructor_event_points_before_season, "
          "cast(row_number() over (partition by season, constructor_id order by event_seq) - 1 as int) "
          "as races_completed_current_season_before_constructor from ge)")
    return [ge, gs]


def _std_sql(compat: bool):
    return (with_prep(*_std_ctes(compat)) +
            f"select p.driver_id, p.season, p.round, "
            f"{_tot('grand_prix_points', 'p.season, p.driver_id', compat)} as driver_points_before_season, "
            f"{_tot('event_points', 'p.season, p.driver_id', compat)} as driver_event_points_before_season, "
            "cast(row_number() over (partition by p.season, p.driver_id order by p.event_seq) - 1 as int) "
            "as races_completed_current_season_before_driver, "
            "gs.constructor_points_before_season, gs.constructor_event_points_before_season, "
            "gs.races_completed_current_season_before_constructor "
            "from p left join gs on p.season = gs.season and p.round = gs.round and p.constructor_id = gs.constructor_id")


STD_COLS = KEY + ["driver_points_before_season", "driver_event_points_before_season",
                  "races_completed_current_season_before_driver", "constructor_points_before_season",
                  "constructor_event_points_before_season", "races_completed_current_season_before_constructor"]


@register("w4_season_to_date", _std_sql(False), "W4,W3,F11,F12,F13,J7")
def q_std(spark, sf_dir):
    return present(feature_panel(spark, sf_dir), STD_COLS)


@register("w4_season_to_date_compat", _std_sql(True), "W4,D8")
def q_std_compat(spark, sf_dir):
    return present(feature_panel(spark, sf_dir, S.with_mode("compat")), STD_COLS)


# ------------------------------------------------------------------ group form
A1_COLS = ["season", "round", "constructor_id", "constructor_points", "constructor_event_points",
           "constructor_finish", "constructor_top10", "constructor_podium", "constructor_dnf",
           "constructor_grid", "constructor_quali"]
A1_SQL = ("a1 as (select season, round, event_seq, constructor_id, "
          "cast(sum(grand_prix_points) as bigint) as constructor_points, "
          "cast(sum(event_points) as bigint) as constructor_event_points, "
          "avg(position_order) as constructor_finish, avg(target_top10) as constructor_top10, "
          "avg(target_podium) as constructor_podium, avg(is_dnf) as constructor_dnf, "
          "avg(grid_position) as constructor_grid, avg(quali_position) as constructor_quali "
          "from p where constructor_id is not null group by season, round, event_seq, constructor_id)")


@register("a1_group_event_aggregate",
          with_prep(A1_SQL) + "select season, round, constructor_id, constructor_points, constructor_event_points, "
          + rounded(A1_COLS[5:]) + " from a1", "A1")
def q_a1(spark, sf_dir):
    x = H.entity_history(prepared_panel(spark, sf_dir), S)
    cr = H.group_history(H.group_event_table(x, S), S)
    return present(cr, A1_COLS)


GROUP_FORM_COLS = ["constructor_races_before"] + [
    c for n in S.windows for c in (
        [f"constructor_avg_finish_last_{n}", f"constructor_points_last_{n}", f"constructor_event_points_last_{n}"]
        + ([f"constructor_top10_rate_last_{n}", f"constructor_podium_rate_last_{n}", f"constructor_dnf_rate_last_{n}"]
           if n in S.rate_windows else []))
] + ["constructor_avg_grid_last_5", "constructor_avg_quali_last_5"]


def _group_form_sql():
    sel = ["season", "round", "constructor_id",
           "cast(row_number() over (partition by constructor_id order by event_seq) - 1 as int) as constructor_races_before"]
    dbl = []
    for n in S.windows:
        sel.append(f"avg(constructor_finish) {_over('constructor_id', _rows(n))} as constructor_avg_finish_last_{n}")
        dbl.append(f"constructor_avg_finish_last_{n}")
        sel.append(f"cast(sum(constructor_points) {_over('constructor_id', _rows(n))} as bigint) as constructor_points_last_{n}")
        sel.append(f"cast(sum(constructor_event_points) {_over('constructor_id', _rows(n))} as bigint) as constructor_event_points_last_{n}")
        if n in S.rate_windows:
            for c, name in (("constructor_top10", "top10_rate"), ("constructor_podium", "podium_rate"),
                            ("constructor_dnf", "dnf_rate")):
                sel.append(f"avg({c}) {_over('constructor_id', _rows(n))} as constructor_{name}_last_{n}")
                dbl.append(f"constructor_{name}_last_{n}")
    sel.append(f"avg(constructor_grid) {_over('constructor_id', _rows(5))} as constructor_avg_grid_last_5")
    sel.append(f"avg(constructor_quali) {_over('constructor_id', _rows(5))} as constructor_avg_quali_last_5")
    dbl += ["constructor_avg_grid_last_5", "constructor_avg_quali_last_5"]
    gf = "gf as (select " + ", ".join(sel) + " from a1)"
    keep = [c for c in GROUP_FORM_COLS if c not in dbl]
    return (with_prep(A1_SQL, gf) + "select p.driver_id, p.season, p.round, "
            + ", ".join(f"gf.{c}" for c in keep) + ", "
            + ", ".join(f"round(gf.{c}, 6) as {c}" for c in dbl)
            + " from p left join gf on p.season = gf.season and p.round = gf.round "
              "and p.constructor_id = gf.constructor_id")


@register("f8_group_form", _group_form_sql(), "A1,J7,W1,W3,F7,F8,F9,F10")
def q_group_form(spark, sf_dir):
    return present(feature_panel(spark, sf_dir), KEY + GROUP_FORM_COLS)


# -------------------------------------------------------------------- teammate
TEAMMATE_COLS = KEY + ["teammate_quali_position", "teammate_grid_position", "teammate_recent_points_last_5",
                       "quali_position_vs_teammate", "grid_position_vs_teammate"]


def _teammate_sql():
    d5 = f"d5 as (select *, sum(grand_prix_points) {_over('driver_id', _rows(5))} as driver_points_last_5 from p)"

    def tm(x):
        part = "partition by season, round, constructor_id"
        return (f"case when count({x}) over ({part}) > 1 "
                f"then sum({x}) over ({part}) - {x} end")
    t = (f"t as (select driver_id, season, round, quali_position, grid_position, "
         f"cast({tm('quali_position')} as bigint) as teammate_quali_position, "
         f"cast({tm('grid_position')} as bigint) as teammate_grid_position, "
         f"cast({tm('driver_points_last_5')} as bigint) as teammate_recent_points_last_5 from d5)")
    return (with_prep(d5, t) + "select driver_id, season, round, teammate_quali_position, teammate_grid_position, "
            "teammate_recent_points_last_5, quali_position - teammate_quali_position as quali_position_vs_teammate, "
            "grid_position - teammate_grid_position as grid_position_vs_teammate from t")


@register("w5_teammate", _teammate_sql(), "W5,F14,F15")
def q_teammate(spark, sf_dir):
    return present(feature_panel(spark, sf_dir), TEAMMATE_COLS)


# ------------------------------------------------------------------ venue history
VENUE_COLS = KEY + ["driver_avg_finish_on_circuit_before", "driver_points_on_circuit_before",
                    "constructor_avg_finish_on_circuit_before", "constructor_points_on_circuit_before",
                    "circuit_dnf_rate_before", "circuit_avg_grid_to_finish_delta_before"]


def _venue_sql(compat: bool):
    frame = ROWS_PRIOR if compat else RANGE_PRIOR
    order = "event_seq, driver_id" if compat else "event_seq"
    dbl = ["driver_avg_finish_on_circuit_before", "constructor_avg_finish_on_circuit_before",
           "circuit_dnf_rate_before", "circuit_avg_grid_to_finish_delta_before"]
    inner = (with_prep() + "select driver_id, season, round, "
             f"avg(position_order) {_over('driver_id, circuit_id', ROWS_PRIOR)} as driver_avg_finish_on_circuit_before, "
             f"cast(sum(grand_prix_points) {_over('driver_id, circuit_id', ROWS_PRIOR)} as bigint) as driver_points_on_circuit_before, "
             f"avg(position_order) {_over('constructor_id, circuit_id', frame, order)} as constructor_avg_finish_on_circuit_before, "
             f"cast(sum(grand_prix_points) {_over('constructor_id, circuit_id', frame, order)} as bigint) as constructor_points_on_circuit_before, "
             f"avg(is_dnf) {_over('circuit_id', frame, order)} as circuit_dnf_rate_before, "
             f"avg(grid_to_finish_delta) {_over('circuit_id', frame, order)} as circuit_avg_grid_to_finish_delta_before "
             "from p")
    return _wrap((inner, dbl), VENUE_COLS)


@register("w2_venue_history", _venue_sql(False), "W2,F16,F17,F18,F19")
def q_venue(spark, sf_dir):
    return present(feature_panel(spark, sf_dir), VENUE_COLS)


@register("w2_venue_history_compat", _venue_sql(True), "W2,D1")
def q_venue_compat(spark, sf_dir):
    return present(feature_panel(spark, sf_dir, S.with_mode("compat")), VENUE_COLS)


# ------------------------------------------------------- share, rank, flags
RANK_COLS = KEY + ["driver_points_share_before", "constructor_points_share_before",
                   "driver_official_standings_points_before", "constructor_official_standings_points_before",
                   "driver_strength_rank_before", "constructor_strength_rank_before"]


def _rank_sql():
    std = f"""std as (select p.driver_id, p.season, p.round, p.constructor_id,
  coalesce(sum(grand_prix_points) {_over('p.season, p.driver_id', ROWS_PRIOR)}, 0) as dp,
  coalesce(sum(event_points) {_over('p.season, p.driver_id', ROWS_PRIOR)}, 0) as dep,
  gs.constructor_points_before_season as cp, gs.constructor_event_points_before_season as cep
  from p left join gs on p.season = gs.season and p.round = gs.round and p.constructor_id = gs.constructor_id)"""
    return with_prep(*_std_ctes(False), std) + f"""select driver_id, season, round,
  round(dp / nullif(max(dp) over (partition by season, round), 0), 6) as driver_points_share_before,
  round(cp / nullif(max(cp) over (partition by season, round), 0), 6) as constructor_points_share_before,
  cast(dep as bigint) as driver_official_standings_points_before,
  cast(cep as bigint) as constructor_official_standings_points_before,
  case when dp is not null then cast(dense_rank() over (partition by season, round order by dp desc) as int) end
    as driver_strength_rank_before,
  case when cp is not null then cast(dense_rank() over (partition by season, round order by cp desc) as int) end
    as constructor_strength_rank_before
from std"""


@register("w7_share_and_strength_rank", _rank_sql(), "W6,W7,F20,F21,F27")
def q_rank(spark, sf_dir):
    return present(feature_panel(spark, sf_dir), RANK_COLS)


LIVE = S.live_season
LIVE_COLS = KEY + [f"driver_recent_points_last_3_{LIVE}", f"driver_recent_points_last_5_{LIVE}",
                   f"constructor_recent_points_last_3_{LIVE}", f"constructor_recent_points_last_5_{LIVE}",
                   f"driver_top10_rate_{LIVE}_before", f"constructor_top10_rate_{LIVE}_before",
                   f"driver_avg_finish_{LIVE}_before", f"constructor_avg_finish_{LIVE}_before",
                   f"driver_avg_quali_{LIVE}_before", f"constructor_avg_quali_{LIVE}_before",
                   f"driver_reliability_rate_{LIVE}_before", f"constructor_reliability_rate_{LIVE}_before"]


def _live_sql(compat: bool):
    L = LIVE
    dpart = "driver_id" if compat else "p.season, driver_id"
    cpart = "constructor_id" if compat else "p.season, p.constructor_id"
    cframe = ROWS_PRIOR if compat else RANGE_PRIOR
    corder = "event_seq, driver_id" if compat else "event_seq"

    def m(expr):
        return f"case when season = {L} then {expr} end"
    if compat:
        crec = [f"cast({m(f'sum(event_points) {_over(cpart, _rows(n), corder)}')} as bigint)" for n in (3, 5)]
        cte = []
    else:
        cte = [("ce as (select season, round, event_seq, constructor_id, sum(event_points) as cep from p "
                "where constructor_id is not null group by season, round, event_seq, constructor_id)"),
               ("cr as (select season, round, constructor_id, "
                + ", ".join(f"sum(cep) {_over('season, constructor_id', _rows(n))} as r{n}" for n in (3, 5))
                + " from ce)")]
        crec = [f"cast({m(f'cr.r{n}')} as bigint)" for n in (3, 5)]
    sel = [
        "p.driver_id", "p.season", "p.round",
        f"cast({m(f'sum(event_points) {_over(dpart, _rows(3))}')} as bigint) as driver_recent_points_last_3_{L}",
        f"cast({m(f'sum(event_points) {_over(dpart, _rows(5))}')} as bigint) as driver_recent_points_last_5_{L}",
        f"{crec[0]} as constructor_recent_points_last_3_{L}",
        f"{crec[1]} as constructor_recent_points_last_5_{L}",
        f"round({m(f'avg(target_top10) {_over(dpart, ROWS_PRIOR)}')}, 6) as driver_top10_rate_{L}_before",
        f"round({m(f'avg(target_top10) {_over(cpart, cframe, corder)}')}, 6) as constructor_top10_rate_{L}_before",
        f"round({m(f'avg(position_order) {_over(dpart, ROWS_PRIOR)}')}, 6) as driver_avg_finish_{L}_before",
        f"round({m(f'avg(position_order) {_over(cpart, cframe, corder)}')}, 6) as constructor_avg_finish_{L}_before",
        f"round({m(f'avg(quali_position) {_over(dpart, ROWS_PRIOR)}')}, 6) as driver_avg_quali_{L}_before",
        f"round({m(f'avg(quali_position) {_over(cpart, cframe, corder)}')}, 6) as constructor_avg_quali_{L}_before",
        f"round({m(f'1 - avg(is_dnf) {_over(dpart, ROWS_PRIOR)}')}, 6) as driver_reliability_rate_{L}_before",
        f"round({m(f'1 - avg(is_dnf) {_over(cpart, cframe, corder)}')}, 6) as constructor_reliability_rate_{L}_before",
    ]
    sel = [s.replace("case when season", "case when p.season") for s in sel]
    src = "p" if compat else ("p left join cr on p.season = cr.season and p.round = cr.round "
                              "and p.constructor_id = cr.constructor_id")
    return with_prep(*cte) + "select " + ",\n ".join(sel) + f" from {src}"


@register("w12_live_season_history", _live_sql(False), "W12,F22,F23,F24,F25,F26")
def q_live(spark, sf_dir):
    return present(feature_panel(spark, sf_dir), LIVE_COLS)


@register("w12_live_season_history_compat", _live_sql(True), "W12,D2")
def q_live_compat(spark, sf_dir):
    return present(feature_panel(spark, sf_dir, S.with_mode("compat")), LIVE_COLS)


MISSING_COLS = KEY + ["missing_driver_history", "missing_constructor_history", "missing_circuit_history"]


@register("f28_missing_history",
          with_prep(A1_SQL) + f"""select p.driver_id, p.season, p.round,
  cast(avg(p.position_order) {_over('p.driver_id', _rows(5), 'p.event_seq')} is null as int) as missing_driver_history,
  cast(c.f5 is null as int) as missing_constructor_history,
  cast(avg(p.position_order) {_over('p.driver_id, p.circuit_id', ROWS_PRIOR, 'p.event_seq')} is null as int) as missing_circuit_history
from p left join (select season, round, constructor_id,
   avg(constructor_finish) {_over('constructor_id', _rows(5))} as f5 from a1) c
  on p.season = c.season and p.round = c.round and p.constructor_id = c.constructor_id""",
          "F28")
def q_missing(spark, sf_dir):
    return present(feature_panel(spark, sf_dir), MISSING_COLS)
