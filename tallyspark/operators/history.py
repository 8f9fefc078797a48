"""Leakage-safe history features.

Plan design
-----------
* Entity histories (driver grain) share ONE window partitioning: every
  entity window is partitioned by the entity, or by a superset of it
  (``season, entity`` / ``entity, venue``).  Spark's ``HashPartitioning(entity)``
  satisfies the clustered distribution of the supersets, so the whole entity
  block costs one exchange plus sorts.  Entity partitions are small (one row
  per event the entity took part in), so they never become hot.
* Group, venue and event features are computed on an event x group
  pre-aggregate (A1): ONE partial/final hash aggregate over the panel gives
  sums and counts per (event, group).  Venue and event histories are sums of
  those rows.  Windows then run on a table of (#events x #groups) rows instead
  of the panel, so a hot group or venue cannot skew a window partition.
* Everything per event that the original code computes with a window over all
  rows of the event (teammate sums, share of the leader, dense strength rank)
  becomes a grouped aggregate joined back on the event keys.  The joined sides
  are bounded by #events x #groups or by #events x #distinct values, so they
  are broadcast by AQE from runtime statistics; the panel itself is not
  shuffled again.

Modes
-----
``strict`` (default): nothing of the current event is visible; expanding
group/venue frames range over prior *events*.  ``compat``: the original
row-level shift inside group and venue partitions (later rows of the same
event see earlier rows) and the career windows masked to the live season.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..spec import PanelSpec

UNB = Window.unboundedPreceding


def prior_rows(w, n: int | None = None):
    """Frame of the ``n`` previous rows (all previous rows when n is None)."""
    return w.rowsBetween(UNB if n is None else -n, -1)


def ratio(num: Column, den: Column) -> Column:
    """num / den, null when den is 0 or null (ANSI-safe)."""
    return F.try_divide(num.cast("double"), F.nullif(den, F.lit(0)).cast("double"))


def running_total_before(x: str, w, compat: bool) -> Column:
    """W4 season-to-date total strictly before the row.

    strict: running sum of the previous rows, 0 when none.
    compat: 0 whenever the immediately previous value is null (D8)."""
    total = F.coalesce(F.sum(x).over(prior_rows(w)), F.lit(0))
    if compat:
        return F.when(F.lag(x).over(w).isNull(), F.lit(0)).otherwise(total)
    return total


# --------------------------------------------------------------------------
# entity grain
# --------------------------------------------------------------------------

def entity_columns(spec: PanelSpec, ties: tuple[str, ...] = ()) -> dict[str, Column]:
    """F1-F6, F11, F12, F16, F22 and the driver half of F24-F26. ``ties``
    order the rows of an entity that is listed twice in an event."""
    e, seq = spec.entity, (spec.seq, *ties)
    w = Window.partitionBy(e).orderBy(*seq)
    ws = Window.partitionBy(spec.season, e).orderBy(*seq)
    wv = Window.partitionBy(e, spec.venue).orderBy(*seq)
    live = F.col(spec.season) == spec.live_season
    cols: dict[str, Column] = {"driver_races_before": F.row_number().over(w) - 1}
    for n in spec.windows:
        cols[f"driver_avg_finish_last_{n}"] = F.avg(spec.finish).over(prior_rows(w, n))
        cols[f"driver_points_last_{n}"] = F.sum("grand_prix_points").over(prior_rows(w, n))
        cols[f"driver_event_points_last_{n}"] = F.sum("event_points").over(prior_rows(w, n))
        if n in spec.rate_windows:
            cols[f"driver_top10_rate_last_{n}"] = F.avg("target_top10").over(prior_rows(w, n))
            cols[f"driver_podium_rate_last_{n}"] = F.avg("target_podium").over(prior_rows(w, n))
            cols[f"driver_dnf_rate_last_{n}"] = F.avg("is_dnf").over(prior_rows(w, n))
    cols["driver_avg_grid_last_5"] = F.avg("grid_position").over(prior_rows(w, 5))
    cols["driver_avg_quali_last_5"] = F.avg(spec.quali).over(prior_rows(w, 5))
    compat = spec.mode == "compat"
    cols["driver_points_before_season"] = running_total_before("grand_prix_points", ws, compat)
    cols["driver_event_points_before_season"] = running_total_before("event_points", ws, compat)
    cols["races_completed_current_season_before_driver"] = F.row_number().over(ws) - 1
    cols["driver_avg_finish_on_circuit_before"] = F.avg(spec.finish).over(prior_rows(wv))
    cols["driver_points_on_circuit_before"] = F.sum("grand_prix_points").over(prior_rows(wv))
    # live-season history: strict restricts the frame to the season,
    # compat masks the career window.
    wl = w if compat else ws
    ls = spec.live_season
    for n in (3, 5):
        cols[f"driver_recent_points_last_{n}_{ls}"] = F.when(
            live, F.sum("event_points").over(prior_rows(wl, n)))
    cols[f"driver_top10_rate_{ls}_before"] = F.when(live, F.avg("target_top10").over(prior_rows(wl)))
    cols[f"driver_avg_finish_{ls}_before"] = F.when(live, F.avg(spec.finish).over(prior_rows(wl)))
    cols[f"driver_avg_quali_{ls}_before"] = F.when(live, F.avg(spec.quali).over(prior_rows(wl)))
    cols[f"driver_reliability_rate_{ls}_before"] = F.when(
        live, 1 - F.avg("is_dnf").over(prior_rows(wl)))
    return cols


def entity_history(df: DataFrame, spec: PanelSpec, ties: tuple[str, ...] = ()) -> DataFrame:
    return df.withColumns(entity_columns(spec, ties))


# --------------------------------------------------------------------------
# event x group grain (A1)
# --------------------------------------------------------------------------

_GE_SOURCES = {
    # name -> source column of the panel
    "finish": None, "top10": "target_top10", "podium": "target_podium",
    "dnf": "is_dnf", "grid": "grid_position", "quali": None, "delta": "grid_to_finish_delta",
}


def group_event_table(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """A1 + the per-(event, group) sums needed by W5 and venue histories.

    Teammate points use ``driver_points_last_5`` and share-of-leader the
    season-to-date total of ``entity_history``, where the panel has them.
    One hash aggregate with map-side partial aggregation.
    """
    src = dict(_GE_SOURCES, finish=spec.finish, quali=spec.quali)
    aggs = [
        F.sum("grand_prix_points").alias("constructor_points"),
        F.sum("event_points").alias("constructor_event_points"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count("grand_prix_points").alias("cnt_gp"),
    ]
    if "driver_points_before_season" in df.columns:
        aggs.append(F.max("driver_points_before_season").alias("max_driver_points_before_season"))
    for name, c in src.items():
        aggs.append(F.sum(c).alias(f"sum_{name}"))
        aggs.append(F.count(c).alias(f"cnt_{name}"))
    for c in (spec.quali, "grid_position", "driver_points_last_5"):
        if c not in df.columns:
            continue
        aggs.append(F.sum(c).alias(f"tm_sum_{c}"))
        aggs.append(F.count(c).alias(f"tm_cnt_{c}"))
    keys = [spec.season, spec.round, spec.seq, spec.venue, spec.group]
    return df.groupBy(*keys).agg(*aggs)


def group_columns(spec: PanelSpec) -> dict[str, Column]:
    """F7-F10, F13, strict F17 and strict group half of F23-F26 on A1 rows."""
    g, seq = spec.group, spec.seq
    w = Window.partitionBy(g).orderBy(seq)
    ws = Window.partitionBy(spec.season, g).orderBy(seq)
    wv = Window.partitionBy(g, spec.venue).orderBy(seq)
    cols: dict[str, Column] = {"constructor_races_before": F.row_number().over(w) - 1}
    for n in spec.windows:
        cols[f"constructor_avg_finish_last_{n}"] = F.avg("constructor_finish").over(prior_rows(w, n))
        cols[f"constructor_points_last_{n}"] = F.sum("constructor_points").over(prior_rows(w, n))
        cols[f"constructor_event_points_last_{n}"] = F.sum("constructor_event_points").over(prior_rows(w, n))
        if n in spec.rate_windows:
            for srcc, name in (("constructor_top10", "top10_rate"), ("constructor_podium", "podium_rate"),
                               ("constructor_dnf", "dnf_rate")):
                cols[f"constructor_{name}_last_{n}"] = F.avg(srcc).over(prior_rows(w, n))
    cols["constructor_avg_grid_last_5"] = F.avg("constructor_grid").over(prior_rows(w, 5))
    cols["constructor_avg_quali_last_5"] = F.avg("constructor_quali").over(prior_rows(w, 5))
    compat = spec.mode == "compat"
    cols["constructor_points_before_season"] = running_total_before("constructor_points", ws, compat)
    cols["constructor_event_points_before_season"] = running_total_before("constructor_event_points", ws, compat)
    cols["races_completed_current_season_before_constructor"] = F.row_number().over(ws) - 1
    if not compat:
        cols["constructor_avg_finish_on_circuit_before"] = ratio(
            F.sum("sum_finish").over(prior_rows(wv)), F.sum("cnt_finish").over(prior_rows(wv)))
        cols["constructor_points_on_circuit_before"] = F.sum("constructor_points").over(prior_rows(wv))
        live = F.col(spec.season) == spec.live_season
        ls = spec.live_season
        for n in (3, 5):
            cols[f"constructor_recent_points_last_{n}_{ls}"] = F.when(
                live, F.sum("constructor_event_points").over(prior_rows(ws, n)))
        for feat, name in (("top10", f"constructor_top10_rate_{ls}_before"),
                           ("finish", f"constructor_avg_finish_{ls}_before"),
                           ("quali", f"constructor_avg_quali_{ls}_before")):
            cols[name] = F.when(live, ratio(F.sum(f"sum_{feat}").over(prior_rows(ws)),
                                            F.sum(f"cnt_{feat}").over(prior_rows(ws))))
        cols[f"constructor_reliability_rate_{ls}_before"] = F.when(
            live, 1 - ratio(F.sum("sum_dnf").over(prior_rows(ws)), F.sum("cnt_dnf").over(prior_rows(ws))))
    return cols


def group_history(ge: DataFrame, spec: PanelSpec) -> DataFrame:
    cr = ge.filter(F.col(spec.group).isNotNull())  # null group keys are not a group
    means = ("finish", "top10", "podium", "dnf", "grid", "quali")
    cr = cr.withColumns({f"constructor_{c}": ratio(F.col(f"sum_{c}"), F.col(f"cnt_{c}")) for c in means})
    return cr.withColumns(group_columns(spec))


def event_table(ge: DataFrame, spec: PanelSpec) -> DataFrame:
    """Event grain: venue histories (strict F18/F19) and event maxima."""
    ev = ge.groupBy(spec.season, spec.round, spec.seq, spec.venue).agg(
        F.sum("sum_dnf").alias("ev_sum_dnf"), F.sum("cnt_dnf").alias("ev_cnt_dnf"),
        F.sum("sum_delta").alias("ev_sum_delta"), F.sum("cnt_delta").alias("ev_cnt_delta"),
        F.max("max_driver_points_before_season").alias("ev_max_driver_points"),
    )
    wv = Window.partitionBy(spec.venue).orderBy(spec.seq)
    cols = {}
    if spec.mode == "strict":
        cols["circuit_dnf_rate_before"] = ratio(F.sum("ev_sum_dnf").over(prior_rows(wv)),
                                                F.sum("ev_cnt_dnf").over(prior_rows(wv)))
        cols["circuit_avg_grid_to_finish_delta_before"] = ratio(
            F.sum("ev_sum_delta").over(prior_rows(wv)), F.sum("ev_cnt_delta").over(prior_rows(wv)))
    return ev.withColumns(cols)


def compat_row_level_features(df: DataFrame, spec: PanelSpec, ge: DataFrame | None = None) -> DataFrame:
    """D1 reproduction: row-level shift inside group/venue partitions
    (rows ordered by (seq, entity); later rows of an event see earlier ones).

    The expanding means/sums decompose exactly into
      (everything of prior events)  +  (earlier rows of the same event):
    the first part is a cumulative sum over the event x group table (bounded
    by #events x #groups), the second a running total inside each (event[,
    group]) ordered by entity (``ordered.prefix_sums``).  No
    window ever holds a whole venue or group.

    Only the columns that the totals need are sorted and summed; the features
    come back to the panel by the number of the row, so that it moves once.
    That number stays as the column ``_row``."""
    from ..session import materialize
    from .ordered import prefix_sums
    df = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "row_level")
    g, v, seq, e = spec.group, spec.venue, spec.seq, spec.entity
    ek = [spec.season, spec.round]
    ls = spec.live_season
    live = F.col(spec.season) == ls
    if ge is None:
        # small and joined in several forms: see add_history_features
        ge = materialize(group_event_table(df, spec), "group_events")
    # ---- prior events: cumulative sums over (group, venue), venue and group
    prior = Window.unboundedPreceding
    wgv = Window.partitionBy(g, v).orderBy(seq).rowsBetween(prior, -1)
    wg = Window.partitionBy(g).orderBy(seq).rowsBetween(prior, -1)
    gcols = {}
    for name, (sc, cc) in {"fin": ("sum_finish", "cnt_finish"), "gp": ("constructor_points", "cnt_gp"),
                           "fing": ("sum_finish", "cnt_finish"), "top10": ("sum_top10", "cnt_top10"),
                           "quali": ("sum_quali", "cnt_quali"), "dnf": ("sum_dnf", "cnt_dnf")}.items():
        win = wgv if name in ("fin", "gp") else wg
        gcols[f"_pg_{name}_s"] = F.coalesce(F.sum(sc).over(win), F.lit(0))
        gcols[f"_pg_{name}_c"] = F.coalesce(F.sum(cc).over(win), F.lit(0))
    gprior = ge.filter(F.col(g).isNotNull()).withColumns(gcols).select(*ek, g, *gcols.keys())
    evt = ge.groupBy(*ek, seq, v).agg(*[F.sum(c).alias(c) for c in ("sum_dnf", "cnt_dnf", "sum_delta", "cnt_delta")])
    wv = Window.partitionBy(v).orderBy(seq).rowsBetween(prior, -1)
    vprior = evt.select(*ek, *[F.coalesce(F.sum(c).over(wv), F.lit(0)).alias(f"_pv_{c}")
                               for c in ("sum_dnf", "cnt_dnf", "sum_delta", "cnt_delta")])
    # ---- same event, earlier entities
    def nn(c):
        return F.when(F.col(c).isNotNull(), F.col(c).cast("double"))

    def counted(name, c):
        return {f"_x_{name}": nn(c), f"_n_{name}": F.col(c).isNotNull().cast("int")}

    of_group_event = {}
    for name, c in {"fin": spec.finish, "gp": "grand_prix_points", "top10": "target_top10", "quali": spec.quali,
                    "dnf": "is_dnf"}.items():
        of_group_event |= counted(name, c)
    of_group_event["_ep"] = F.coalesce(F.col("event_points"), F.lit(0)).cast("long")
    of_event = counted("dnf", "is_dnf") | counted("delta", "grid_to_finish_delta")
    # one pass per (event, group) in entity order: running totals for the
    # expanding features, and event points + position for the rows-based F23
    x = df.select("_row", *ek, g, e, *[c.alias(k) for k, c in of_group_event.items()])
    x = prefix_sums(x, [*ek, g], [(e, True), ("_row", True)], list(of_group_event), out_prefix="_cg", with_position="_pin")
    y = df.select("_row", *ek, e, *[c.alias(k) for k, c in of_event.items()])
    y = prefix_sums(y, ek, [(e, True), ("_row", True)], list(of_event), out_prefix="_ce")
    x, y = x.join(gprior, [*ek, g], "left"), y.join(vprior, ek, "left")

    def before(prefix, name, prior_s, prior_c):
        # inclusive running totals minus the row itself = strictly earlier rows
        s = F.col(f"{prefix}_x_{name}") - F.coalesce(F.col(f"_x_{name}"), F.lit(0.0))
        c = F.col(f"{prefix}_n_{name}") - F.col(f"_n_{name}")
        return (F.coalesce(prior_s, F.lit(0)) + s, F.coalesce(prior_c, F.lit(0)) + c)

    def mean(sc):
        return ratio(sc[0], sc[1])

    def total(sc):
        return F.when(sc[1] > 0, sc[0])

    fin = before("_cg", "fin", F.col("_pg_fin_s"), F.col("_pg_fin_c"))
    fin_g = before("_cg", "fin", F.col("_pg_fing_s"), F.col("_pg_fing_c"))
    gp = before("_cg", "gp", F.col("_pg_gp_s"), F.col("_pg_gp_c"))
    top = before("_cg", "top10", F.col("_pg_top10_s"), F.col("_pg_top10_c"))
    qua = before("_cg", "quali", F.col("_pg_quali_s"), F.col("_pg_quali_c"))
    dnf_g = before("_cg", "dnf", F.col("_pg_dnf_s"), F.col("_pg_dnf_c"))
    dnf_v = before("_ce", "dnf", F.col("_pv_sum_dnf"), F.col("_pv_cnt_dnf"))
    dlt_v = before("_ce", "delta", F.col("_pv_sum_delta"), F.col("_pv_cnt_delta"))
    of_group = F.col(g).isNotNull()  # rows without a group have no group history
    cols = {
        "constructor_avg_finish_on_circuit_before": F.when(of_group, mean(fin)),
        "constructor_points_on_circuit_before": F.when(of_group, total(gp).cast("bigint")),
        f"constructor_top10_rate_{ls}_before": F.when(of_group & live, mean(top)),
        f"constructor_avg_finish_{ls}_before": F.when(of_group & live, mean(fin_g)),
        f"constructor_avg_quali_{ls}_before": F.when(of_group & live, mean(qua)),
        f"constructor_reliability_rate_{ls}_before": F.when(of_group & live, 1 - mean(dnf_g)),
    }
    venue_cols = {
        "circuit_dnf_rate_before": mean(dnf_v),
        "circuit_avg_grid_to_finish_delta_before": mean(dlt_v),
    }
    # read by the join below and by the windows of F23
    x = materialize(_recent_inputs(x, ge, spec).select(
        "_row", g, *[c.alias(k) for k, c in cols.items()], "_P", "_ep", "_live", "_context"), "row_history")
    recent = _compat_recent_rows(x, spec)
    features = [x.select("_row", *cols), y.select("_row", *[c.alias(k) for k, c in venue_cols.items()]), recent]
    out = df
    for f in features:
        out = out.join(f, "_row", "left")
    names = list(cols)
    names[2:2] = venue_cols
    return out.select(*df.columns, *names, *[c for c in recent.columns if c != "_row"])


def _recent_inputs(x: DataFrame, ge: DataFrame, spec: PanelSpec) -> DataFrame:
    """The position ``_P`` of each row in its group, in (seq, entity) order:
    rows of prior events, a cumulative sum over the event x group table, plus
    the position ``_pin`` inside the event. ``_context`` tells the rows of the
    live season and the five positions before its first."""
    g, ek = spec.group, [spec.season, spec.round]
    live = F.col(spec.season) == spec.live_season
    w = Window.partitionBy(g).orderBy(spec.seq).rowsBetween(UNB, -1)
    prior = ge.filter(F.col(g).isNotNull()).select(*ek, g, F.coalesce(F.sum("n_rows").over(w), F.lit(0)).alias("_rows_before"))
    prior = prior.withColumn("_first_live", F.min(F.when(live, F.col("_rows_before"))).over(Window.partitionBy(g)))
    return x.join(prior, [*ek, g], "left").withColumns({
        "_P": F.col("_rows_before") + F.col("_pin"), "_live": F.coalesce(live, F.lit(False)),
        "_context": F.coalesce(F.col("_rows_before") + F.col("_pin") > F.col("_first_live") - 5, F.lit(False))})


RECENT_BLOCK = 4096


def _compat_recent_rows(x: DataFrame, spec: PanelSpec) -> DataFrame:
    """F23 compat: sum of ``event_points`` over the previous n ROWS of the
    group in (seq, entity) order, for the rows of the live season.

    A group is cut into blocks of positions; the last five rows of a block are
    also given to the next one, so that every frame lies in one block and no
    window holds a whole group."""
    g = spec.group
    at = F.col("_P") - 1
    block = F.floor(at / RECENT_BLOCK)
    tail = at % RECENT_BLOCK >= RECENT_BLOCK - 5
    x = x.where("_context").select("_row", g, "_P", "_ep", "_live", block.alias("_own"),
                                   F.explode(F.when(tail, F.array(block, block + 1)).otherwise(F.array(block))).alias("_block"))
    w = Window.partitionBy(g, "_block").orderBy("_P")
    cols = {f"constructor_recent_points_last_{n}_{spec.live_season}": F.sum("_ep").over(prior_rows(w, n)) for n in (3, 5)}
    return x.withColumns(cols).where(F.col("_live") & (F.col("_block") == F.col("_own"))).select("_row", *cols)


def dense_rank_table(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """(keys, value, dense rank descending) for every distinct non-null value."""
    from ..session import materialize
    from .ordered import position_within
    distinct = df.select(*keys, value).where(F.col(value).isNotNull()).distinct()
    # written, so that a join knows its size and need not shuffle the panel
    return materialize(position_within(distinct, keys, [(value, False)], out), "ranks")


def dense_rank_desc_within(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """W7 dense rank (descending) of ``value`` within ``keys``; null stays null.

    Ranks the distinct (keys, value) pairs - a partial-aggregated distinct, so
    a hot key contributes its distinct values only - and joins them back.
    Over distinct values the position in descending order IS the dense rank;
    ``position_within`` keeps even a key with very many distinct values off a
    single task.
    """
    return df.join(dense_rank_table(df, keys, value, out), [*keys, value], "left")


VENUE_FEATURES = ("circuit_dnf_rate_before", "circuit_avg_grid_to_finish_delta_before")
STRENGTH_RANKS = {f"{who}_points_before_season": f"{who}_strength_rank_before" for who in ("driver", "constructor")}
TEAMMATE_HISTORY = {"teammate_recent_points_last_5": "driver_points_last_5"}


def teammate_start(spec: PanelSpec) -> dict[str, str]:
    """Teammate column -> own column, for the starting order."""
    return {"teammate_quali_position": spec.quali, "teammate_grid_position": "grid_position"}


def standing_columns() -> dict[str, Column]:
    """W6 share of the event leader and the official standings."""
    out = {}
    for who in ("driver", "constructor"):
        out[f"{who}_points_share_before"] = ratio(F.col(f"{who}_points_before_season"), F.col(f"ev_max_{who}_points"))
        out[f"{who}_official_standings_points_before"] = F.col(f"{who}_event_points_before_season")
    return out


def cold_start_columns() -> dict[str, Column]:
    """no history yet, told by the column that every history has."""
    seen = {"driver": "driver_avg_finish_last_5", "constructor": "constructor_avg_finish_last_5",
            "circuit": "driver_avg_finish_on_circuit_before"}
    return {f"missing_{what}_history": F.col(c).isNull().cast("int") for what, c in seen.items()}


def add_history_features(df: DataFrame, spec: PanelSpec, materialize_entity: bool = True) -> DataFrame:
    """Prepared panel -> panel with all history features F1-F28.

    The entity-window block is read by three branches (row level, event x
    group aggregate, distinct strength values); ``materialize_entity`` writes
    it once to the shared checkpoint folder instead of recomputing the
    windows per branch."""
    row_level = []
    if spec.mode == "compat":  # first, as long as the panel is narrow
        panel_cols = df.columns
        df = compat_row_level_features(df, spec)
        row_level = [c for c in df.columns if c not in panel_cols and c != "_row"]
    x = entity_history(df, spec, ("_row",) if row_level else ()).drop("_row")
    ge = None
    if materialize_entity:
        from ..session import materialize
        x = materialize(x, "entity_features")
        # small and joined to the panel in several forms: its file tells Spark
        # that they can be broadcast before the panel is shuffled for a join
        ge = materialize(group_event_table(x, spec), "group_events")
    entity = x
    ge = group_event_table(x, spec) if ge is None else ge
    cr = group_history(ge, spec)
    ev = event_table(ge, spec)
    ek = [spec.season, spec.round]
    gk = [*ek, spec.group]

    group_cols = list(group_columns(spec))
    tm_cols = [c for c in ge.columns if c.startswith("tm_")]
    # m:1 by construction: the group-event table is grouped by these keys.
    x = x.join(cr.select(*gk, *group_cols, *tm_cols), gk, "left")
    ev_cols = ["ev_max_driver_points"] + [c for c in VENUE_FEATURES if c in ev.columns]
    x = x.join(ev.select(*ek, *ev_cols), ek, "left")

    # W5 teammate values: partition total minus self, null unless count > 1.
    x = x.withColumns({t: F.when(F.col(f"tm_cnt_{c}") > 1, F.col(f"tm_sum_{c}") - F.col(c))
                       for t, c in (teammate_start(spec) | TEAMMATE_HISTORY).items()}).drop(*tm_cols)
    x = x.withColumns({f"{c}_vs_teammate": F.col(c) - F.col(t) for t, c in teammate_start(spec).items()})
    x = x.select(*[c for c in x.columns if c not in row_level], *row_level)

    # W6 share of the event leader; the constructor maximum comes from a
    # per-event max over the group table (bounded by #events).
    cmax = cr.groupBy(*ek).agg(F.max("constructor_points_before_season").alias("ev_max_constructor_points"))
    x = x.join(cmax, ek, "left")
    x = x.withColumns(standing_columns()).drop("ev_max_driver_points", "ev_max_constructor_points")

    # W7 dense strength ranks within the event.
    drank = dense_rank_table(entity, ek, "driver_points_before_season", STRENGTH_RANKS["driver_points_before_season"])
    x = x.join(drank, [*ek, "driver_points_before_season"], "left")
    crank = dense_rank_table(cr, ek, "constructor_points_before_season", STRENGTH_RANKS["constructor_points_before_season"])
    x = x.join(crank, [*ek, "constructor_points_before_season"], "left")

    # F28 cold-start flags.
    return x.withColumns(cold_start_columns())
