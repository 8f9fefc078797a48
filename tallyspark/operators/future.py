"""As-of feature rows for future events (J13, J14, W8, W10, W-AS, P19-P21,
P28, P30, P32, U2).

The original recomputes the whole history once per future event.  Here one
cut serves all targets that share it:

* history ``H`` = rows strictly before the cut (P19; both the round and the
  as-of date apply, D3),
* entrants = every entity of the last completed event of the live season
  (W10),
* ONE synthetic "next" row per entrant is appended to ``H`` and the regular
  feature builder runs once; the next row's entity and group features are the
  features any target event of the same season would get (nothing happens
  between the cut and a future event),
* venue histories depend on the target's venue: they are as-of aggregates
  of ``H`` per (entity, venue), (group, venue) and venue, joined on the
  target's venue,
* targets (P20) are joined to the snapshot on the season (an equi-join: every
  entrant of the season meets every future event of that season, J13).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..spec import PanelSpec
from .history import add_history_features, ratio
from .ordered import with_scalar

#: Events of one season's calendar that may be broadcast.
MAX_SEASON_EVENTS = 100_000
OUTCOME_COLS = ("position_order", "points", "status", "grid", "quali_position")


def completed_history(df: DataFrame, spec: PanelSpec, season: int, before_round: int | None = None,
                      as_of_seq: int | None = None) -> DataFrame:
    """Rows strictly before (season, round); seasons before ``season``
    are complete.  ``as_of_seq`` also applies a sequence cutoff (D3)."""
    s, r = F.col(spec.season), F.col(spec.round)
    cond = s < season
    if before_round is not None:
        cond = cond | ((s == season) & (r < before_round))
    else:
        cond = cond | (s == season)
    if as_of_seq is not None:
        cond = cond & (F.col(spec.seq) <= as_of_seq)
    return df.filter(cond)


def future_schedule(schedule: DataFrame, spec: PanelSpec, season: int, from_round: int | None = None,
                    only_round: int | None = None) -> DataFrame:
    """P20: one selected round, else every round from ``from_round`` on."""
    s = schedule.filter(F.col(spec.season) == season)
    if only_round is not None:
        return s.filter(F.col(spec.round) == only_round)
    if from_round is not None:
        s = s.filter(F.col(spec.round) >= from_round)
    return s


def last_event_entrants(history: DataFrame, spec: PanelSpec, season: int) -> DataFrame:
    """W10 + W8: entities of the last completed event of ``season``, with
    their identity columns from that row.  The last event is a one-row
    scalar (max over an aggregate)."""
    h = history.filter(F.col(spec.season) == season)
    last = h.agg(F.max(spec.seq).alias("_last_seq"))
    ent = h.join(F.broadcast(last), F.col(spec.seq) == F.col("_last_seq"), "left_semi")
    return ent.select(spec.entity, spec.entity_name, spec.group)


def _next_rows(entrants: DataFrame, history: DataFrame, spec: PanelSpec, season: int,
               next_round: int, venue_placeholder: int = -1) -> DataFrame:
    """One row per entrant at a placeholder event right after the last
    one of the history, every outcome column null (typed like the history)."""
    types = {f.name: f.dataType for f in history.schema.fields}
    cols: dict[str, Column] = {}
    for c in history.columns:
        if c in (spec.entity, spec.entity_name, spec.group):
            continue
        cols[c] = F.lit(None).cast(types[c])
    cols[spec.season] = F.lit(season).cast(types[spec.season])
    cols[spec.round] = F.lit(next_round).cast(types[spec.round])
    cols[spec.venue] = F.lit(venue_placeholder).cast(types[spec.venue])
    after = history.agg((F.max(spec.seq) + 1).cast(types[spec.seq]).alias("_after"))
    cols[spec.seq] = F.col("_after")
    return with_scalar(entrants, after).withColumns(cols).select(*history.columns)


def venue_asof(history: DataFrame, spec: PanelSpec) -> dict[str, DataFrame]:
    """As-of venue aggregates of the history (strict definitions)."""
    e, g, v = spec.entity, spec.group, spec.venue
    ev = history.groupBy(e, v).agg(
        F.avg(spec.finish).alias("driver_avg_finish_on_circuit_before"),
        F.sum("grand_prix_points").alias("driver_points_on_circuit_before"))
    gv = history.filter(F.col(g).isNotNull()).groupBy(g, v).agg(
        F.avg(spec.finish).alias("constructor_avg_finish_on_circuit_before"),
        F.sum("grand_prix_points").alias("constructor_points_on_circuit_before"))
    vv = history.groupBy(v).agg(
        ratio(F.sum("is_dnf"), F.count("is_dnf")).alias("circuit_dnf_rate_before"),
        ratio(F.sum("grid_to_finish_delta"), F.count("grid_to_finish_delta"))
        .alias("circuit_avg_grid_to_finish_delta_before"))
    return {"entity": ev, "group": gv, "venue": vv}


VENUE_FEATURES = ("driver_avg_finish_on_circuit_before", "driver_points_on_circuit_before",
                  "constructor_avg_finish_on_circuit_before", "constructor_points_on_circuit_before",
                  "circuit_dnf_rate_before", "circuit_avg_grid_to_finish_delta_before")


def future_feature_rows(prepared: DataFrame, schedule: DataFrame, spec: PanelSpec, season: int,
                        cut_round: int, only_round: int | None = None,
                        quali_feed: DataFrame | None = None, grid_from_quali: bool = False) -> DataFrame:
    """W-AS / J13 / J14: feature rows for every entrant x future event.

    ``prepared`` is the cleaned panel (``functions.columns.prepare_panel``);
    ``schedule`` has (season, round, seq, venue) per event.  ``quali_feed``
    (season, round, entity, quali) fills qualifying when known (P32); grid
    stays null unless ``grid_from_quali`` (D4)."""
    hist = completed_history(prepared, spec, season, cut_round)
    targets = future_schedule(schedule, spec, season, from_round=cut_round, only_round=only_round)
    entrants = last_event_entrants(hist, spec, season)
    # placeholder event right after the cut: same season, seq after all history
    nxt = _next_rows(entrants, hist, spec, season, cut_round)
    both = hist.withColumn("_next", F.lit(False)).unionByName(nxt.withColumn("_next", F.lit(True)))
    feats = add_history_features(both, spec)
    snap = feats.filter("_next").drop(*VENUE_FEATURES, "_next", spec.round, spec.seq, spec.venue,
                                      "race_round", "missing_circuit_history")
    tsel = targets.select(spec.season, spec.round, spec.seq, spec.venue)
    if tsel.limit(MAX_SEASON_EVENTS + 1).count() > MAX_SEASON_EVENTS:
        raise ValueError(f"more than {MAX_SEASON_EVENTS} events in one season's schedule")
    rows = snap.join(F.broadcast(tsel), spec.season)  # a season's calendar, its size just checked (J13)
    va = venue_asof(hist, spec)
    rows = (rows.join(va["entity"], [spec.entity, spec.venue], "left")
                .join(va["group"], [spec.group, spec.venue], "left")
                .join(va["venue"], spec.venue, "left"))
    rows = rows.withColumns({
        "race_round": F.col(spec.round),
        "missing_circuit_history": F.col("driver_avg_finish_on_circuit_before").isNull().cast("int"),
    })
    if quali_feed is not None:
        q = quali_feed.select(spec.season, spec.round, spec.entity, F.col(spec.quali).alias("_qf"))
        rows = rows.join(q, [spec.season, spec.round, spec.entity], "left").withColumn(
            spec.quali, F.coalesce(F.col("_qf"), F.col(spec.quali))).drop("_qf")
        rows = rows.withColumn("missing_qualifying", F.col(spec.quali).isNull().cast("int"))
        if grid_from_quali:
            rows = rows.withColumn("grid_position", F.coalesce(F.col("grid_position"), F.col(spec.quali)))
    return with_prediction_mode(rows, spec)


def with_prediction_mode(rows: DataFrame, spec: PanelSpec) -> DataFrame:
    """POST-QUALI iff every row of the event has grid and qualifying.

    ``bool_and`` per event is a partial/final aggregate (one row per event,
    joined back), not a window over the event."""
    ready = (F.col("grid_position").isNotNull() & F.col(spec.quali).isNotNull())
    ev = rows.groupBy(spec.season, spec.round).agg(F.bool_and(ready).alias("_ready"))
    return (rows.join(ev, [spec.season, spec.round], "left")
                .withColumn("prediction_mode", F.when(F.col("_ready"), F.lit("POST-QUALI"))
                            .otherwise(F.lit("PRE-QUALI"))).drop("_ready"))


def split_ready(rows: DataFrame, spec: PanelSpec) -> tuple[DataFrame, DataFrame]:
    """Rows ready for post-qualifying scoring vs rows missing inputs."""
    missing = F.col("grid_position").isNull() | F.col(spec.quali).isNull()
    return rows.filter(~missing), rows.filter(missing)


def event_schedule(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Distinct events (season, round, seq, venue) of a panel."""
    return panel.select(spec.season, spec.round, spec.seq, spec.venue).distinct()


def backtest_entity_windows(history: DataFrame, targets: DataFrame, spec: PanelSpec,
                            windows: Sequence[int] = (3, 5)) -> DataFrame:
    """J14 for targets with different cuts: for each (entity, target event),
    aggregates over the entity's last ``w`` rows before the target.

    The entity's rows are numbered once, and a target finds the number of rows
    before it in the same pass (targets are marker rows in the entity's order).
    Positions -1 .. -w are then looked up by an equi-join on (entity, position),
    so the work is rows + targets x w, however many events are back-tested."""
    e, far = spec.entity, max(windows)
    h = history.select(e, F.col(spec.seq).alias("_seq"), spec.finish, "grand_prix_points")
    by = Window.partitionBy(e).orderBy("_seq")
    numbered = h.withColumn("_pos", F.row_number().over(by))
    marks = targets.select(e, F.col(spec.seq).alias("_seq"), spec.season, spec.round, F.lit(None).cast("int").alias("_pos"))
    seen = numbered.select(e, "_seq", "_pos").unionByName(marks, allowMissingColumns=True)
    # markers come before a row of the same event, so only earlier rows count
    upto = Window.partitionBy(e).orderBy("_seq", F.col("_pos").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.max("_pos").over(upto), F.lit(0))
    t = seen.withColumn("driver_races_before", before.cast("int")).filter("_pos is null")
    t = t.select(e, spec.season, spec.round, "driver_races_before",
                 F.explode(F.sequence(F.lit(1), F.lit(far))).alias("_back"))
    look = numbered.select(F.col(e).alias("_e"), F.col("_pos").alias("_at"), spec.finish, "grand_prix_points")
    j = t.join(look, (F.col(e) == F.col("_e")) & (F.col("driver_races_before") - F.col("_back") + 1 == F.col("_at")), "left")
    aggs = [F.max("driver_races_before").alias("driver_races_before")]
    for n in windows:
        inw = F.col("_back") <= n
        aggs.append(F.avg(F.when(inw, F.col(spec.finish))).alias(f"driver_avg_finish_last_{n}"))
        aggs.append(F.sum(F.when(inw, F.col("grand_prix_points"))).alias(f"driver_points_last_{n}"))
    return j.groupBy(e, spec.season, spec.round).agg(*aggs)
