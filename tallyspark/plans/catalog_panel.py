"""Catalogue: the whole modelling panel and summaries over all of its features
(E1, O1, A8, A18). The oracle joins the SQL forms of the feature blocks."""

from __future__ import annotations

from ..operators import profile as PR
from ..operators.split import numeric_feature_columns
from . import catalog_history as CH
from .panel import feature_panel
from .registry import REGISTRY, present, register
from .sqltext import with_prep

#: Registered block -> what it adds to the prepared panel.
BLOCKS = {
    "w1_driver_form": CH.DRIVER_FORM_COLS,
    "w4_season_to_date": CH.STD_COLS[3:],
    "f8_group_form": CH.GROUP_FORM_COLS,
    "w5_teammate": CH.TEAMMATE_COLS[3:],
    "w2_venue_history": CH.VENUE_COLS[3:],
    "w7_share_and_strength_rank": CH.RANK_COLS[3:],
    "w12_live_season_history": CH.LIVE_COLS[3:],
    "f28_missing_history": CH.MISSING_COLS[3:],
}
#: Features that the prepared panel holds already: calendar and starting order.
START_FEATURES = ["season", "round", "race_round", "sprint_weekend_flag", f"is_{CH.LIVE}_regulation", "grid", "grid_position", "quali_position",
                  "missing_qualifying", "grid_vs_quali_delta", "qualified_top3", "qualified_top10", "started_top3", "started_top10"]
FEATURES = sorted([*START_FEATURES, *(c for cols in BLOCKS.values() for c in cols)])


def _panel_sql() -> str:
    blocks = [f"{name} as materialized ({REGISTRY[name].sql})" for name in BLOCKS]
    joins = " ".join(f"left join {name} using (driver_id, season, round)" for name in BLOCKS)
    cols = ", ".join(f"{name}.{c}" for name, names in BLOCKS.items() for c in names)
    return with_prep(*blocks, f"whole as materialized (select p.*, {cols} from p {joins})")


PANEL_SQL = _panel_sql()
LONG_SQL = PANEL_SQL + ", v as materialized (" + " union all ".join(
    f"select driver_id, season as s, round as r, '{c}' as feature, cast({c} as double) as x from whole" for c in FEATURES) + ")"


def _model_features(spark, sf_dir):
    """The panel as it is presented, and the columns that a model may see."""
    fp = present(feature_panel(spark, sf_dir))
    return fp, numeric_feature_columns(fp, "post_quali")


@register("panel_all_features", PANEL_SQL + " select * from whole", "E1,O1")
def q_all(spark, sf_dir):
    return present(feature_panel(spark, sf_dir))


@register("a8_feature_presence_all", LONG_SQL + """
select feature, round(avg(cast(x is null as int)), 6) as null_rate, round(stddev_samp(x), 6) as std
from v group by feature""", "A8")
def q_presence(spark, sf_dir):
    """Null rate and standard deviation of every feature, one aggregate."""
    return present(PR.feature_presence(*_model_features(spark, sf_dir)))


@register("a18_correlation_all", LONG_SQL + """
, c as (
  select a.feature as col_a, b.feature as col_b, count(*) as n, min(a.x) < max(a.x) and min(b.x) < max(b.x) as varies, corr(a.x, b.x) as r
  from v a join v b on a.driver_id = b.driver_id and a.s = b.s and a.r = b.r and a.feature <= b.feature
  where a.x is not null and b.x is not null group by all
), pairs as (
  select a.feature as col_a, b.feature as col_b from (select distinct feature from v) a join (select distinct feature from v) b on a.feature <= b.feature
)
select col_a, col_b, cast(coalesce(n, 0) as bigint) as n, case when varies then round(r, 4) + 0.0 end as corr
from pairs left join c using (col_a, col_b)""", "A18")
def q_correlation(spark, sf_dir):
    """Pearson correlation of every pair of features over the rows that know
    both, from one pass of masked products."""
    return present(PR.correlation_table(*_model_features(spark, sf_dir)), digits=4)
