"""Supplier-month league: the base entity x event table on the supplied tables.

entity = supplier, group = nation, event = ship (year, month), season = year,
round = month, venue = month of year.  finish = rank by revenue, grid = rank
by quantity (0 when the supplier had no open line), qualifying = rank by
urgent-order quantity (null when none), status from the returned share,
points from the league points table.

Plan shape: ``lineitem`` is aggregated to (supplier, year, month) before any
join (map-side partial aggregation, one narrow shuffle).  Only the urgent
quantity needs ``orders``: ``lineitem`` is semi-joined to the urgent orders
(the priority filter is pushed into the ``orders`` scan and the semi join
ships only keys), then aggregated to the same grain and joined to the
aggregate, which is small.  The supplier dimension joins the aggregate, not
the line items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import read_table

# League points for finishing positions 1..10, 0 afterwards.
POINTS_TABLE = (25, 18, 15, 12, 10, 8, 6, 4, 2, 1)
# First season of the panel (event_seq = (season - 1995) * 12 + round).
FIRST_SEASON = 1995


def points_for(position_col) -> F.Column:
    expr = F.lit(0)
    for pos in range(len(POINTS_TABLE), 0, -1):
        expr = F.when(position_col == pos, F.lit(POINTS_TABLE[pos - 1])).otherwise(expr)
    return expr


def monthly_supplier_aggregate(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    # year and month travel as one number: less to shuffle, join and group by
    month = (F.year("l_shipdate").cast("int") * 12 + F.month("l_shipdate").cast("int") - 1).alias("_month")
    li = lineitem.select(
        F.col("l_orderkey"), F.col("l_suppkey").alias("driver_id"), month,
        F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_returnflag"),
        F.col("l_linestatus"))
    base = li.groupBy("driver_id", "_month").agg(
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("rev_cents"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).cast("bigint").alias("n_ret"),
        F.sum(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).cast("bigint").alias("n_open"),
    )
    urgent_orders = orders.filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("l_orderkey"))
    urgent = (li.select("l_orderkey", "driver_id", "_month", "l_quantity")
                .join(urgent_orders, "l_orderkey", "left_semi")
                .groupBy("driver_id", "_month")
                .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("urgent_qty")))
    return base.join(urgent, ["driver_id", "_month"], "left").select(
        "driver_id", F.floor(F.col("_month") / 12).cast("int").alias("season"), (F.pmod("_month", F.lit(12)) + 1).alias("round"),
        "rev_cents", "qty", "n_lines", "n_ret", "n_open", F.coalesce("urgent_qty", F.lit(0).cast("bigint")).alias("urgent_qty"))


def supplier_month_panel(lineitem: DataFrame, orders: DataFrame,
                         supplier: DataFrame, distributed_ranks: bool = True) -> DataFrame:
    """Positions inside an event are row numbers over (event, value desc,
    entity).  ``distributed_ranks`` computes them with
    ``ordered.position_within`` (value buckets, no task holds a whole event)
    on the materialised monthly aggregate; ``False`` uses plain windows
    partitioned by event (fine when events are small)."""
    m = monthly_supplier_aggregate(lineitem, orders)
    sup = supplier.select(F.col("s_suppkey").alias("driver_id"),
                          F.col("s_name").alias("driver_name"),
                          F.col("s_nationkey").alias("constructor_id"))
    r = m.join(sup, "driver_id")
    ev = ["season", "round"]
    if distributed_ranks:
        from ..operators.ordered import position_within
        from ..session import materialize
        # read by every rank: write the small aggregate once. Only the ranked
        # columns are sorted and come back by the number of the row; the last
        # rank takes all columns along and leaves the rows in its order, which
        # later windows rely on where a supplier is listed twice.
        r = rows = materialize(r.withColumn("_row", F.monotonically_increasing_id()), "monthly_aggregate")
        ties = [("driver_id", True), ("_row", True)]
        for value, out in (("rev_cents", "_pos_rev"), ("qty", "_pos_qty")):
            ranked = position_within(rows.select("_row", *ev, value, "driver_id"), ev, [(value, False), *ties], out, keep=["_row"])
            r = r.join(ranked.select("_row", out), "_row")
        kept = [c for c in r.columns if c not in ("_row", "rev_cents", "qty")]
        r = position_within(r, ev, [("urgent_qty", False), *ties], "_pos_urg", keep=kept)
        pos_rev, pos_qty, pos_urg = F.col("_pos_rev"), F.col("_pos_qty"), F.col("_pos_urg")
    else:
        w = Window.partitionBy(*ev)
        pos_rev = F.row_number().over(w.orderBy(F.desc("rev_cents"), "driver_id"))
        pos_qty = F.row_number().over(w.orderBy(F.desc("qty"), "driver_id"))
        pos_urg = F.row_number().over(w.orderBy(F.desc("urgent_qty"), "driver_id"))
    r = r.select(
        "driver_id", "driver_name", "constructor_id",
        F.col("round").alias("circuit_id"), "season", "round",
        ((F.col("season") - FIRST_SEASON) * 12 + F.col("round")).cast("int").alias("event_seq"),
        pos_rev.cast("int").alias("position_order"),
        F.when(F.col("n_open") == 0, F.lit(0)).otherwise(pos_qty.cast("int")).alias("grid"),
        F.when(F.col("urgent_qty") == 0, F.lit(None).cast("int")).otherwise(pos_urg.cast("int")).alias("quali_position"),
        F.when(F.col("n_ret") * 2 > F.col("n_lines"), "Retired")
         .when(F.col("n_ret") == 0, "Finished").otherwise("+1 Lap").alias("status"),
    )
    return r.withColumn("points", points_for(F.col("position_order")))


def fixture_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_month_panel(read_table(spark, sf_dir, "lineitem"),
                                read_table(spark, sf_dir, "orders"),
                                read_table(spark, sf_dir, "supplier"))


# The same panel as SQL text; used as a common table expression by the oracle.
PANEL_SQL = """
with m as (
  select l.l_suppkey as driver_id,
         cast(year(l.l_shipdate) as int) as season, cast(month(l.l_shipdate) as int) as round,
         cast(sum(cast(round(l.l_extendedprice * 100) as bigint)) as bigint) as rev_cents,
         cast(sum(cast(l.l_quantity as bigint)) as bigint) as qty,
         cast(sum(case when o.o_orderpriority = '1-URGENT' then cast(l.l_quantity as bigint) else 0 end) as bigint) as urgent_qty,
         cast(count(*) as bigint) as n_lines,
         cast(sum(case when l.l_returnflag = 'R' then 1 else 0 end) as bigint) as n_ret,
         cast(sum(case when l.l_linestatus = 'O' then 1 else 0 end) as bigint) as n_open
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey
  group by l.l_suppkey, cast(year(l.l_shipdate) as int), cast(month(l.l_shipdate) as int)
), r as (
  select m.*, s.s_name as driver_name, s.s_nationkey as constructor_id,
         m.round as circuit_id, (m.season - 1995) * 12 + m.round as event_seq,
         cast(row_number() over (partition by season, round order by rev_cents desc, driver_id) as int) as position_order,
         case when n_open = 0 then 0
              else cast(row_number() over (partition by season, round order by qty desc, driver_id) as int) end as grid,
         case when urgent_qty = 0 then null
              else cast(row_number() over (partition by season, round order by urgent_qty desc, driver_id) as int) end as quali_position,
         case when n_ret * 2 > n_lines then 'Retired' when n_ret = 0 then 'Finished' else '+1 Lap' end as status
  from m join supplier s on m.driver_id = s.s_suppkey
)
select driver_id, driver_name, constructor_id, circuit_id, season, round, cast(event_seq as int) as event_seq,
       position_order, grid, quali_position, status,
       case position_order when 1 then 25 when 2 then 18 when 3 then 15 when 4 then 12 when 5 then 10
            when 6 then 8 when 7 then 6 when 8 then 4 when 9 then 2 when 10 then 1 else 0 end as points
from r
"""
