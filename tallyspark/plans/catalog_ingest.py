"""Catalogue: ingestion joins, entity resolution, nested snapshots, unions,
incremental ingest (S5-S10, J1-J10, P1, P2, P14, P16, U1, T1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import full_name
from ..functions.names import normalize_name
from ..operators import joins as J
from ..operators.ordered import position_within
from ..sources import snapshots as SN
from ..sources.tables import read_table
from ..spec import DEFAULT_SPEC
from .panel import base_panel
from .registry import register
from .sqltext import with_prep

S = DEFAULT_SPEC
LIVE = S.live_season
CLOSED_MAX = LIVE - 1


# ------------------------------------------------------------ J1-J3 star join
STAR_SQL = """
select l.l_orderkey, l.l_linenumber, l.l_suppkey, s.s_name, n.n_name, r.r_name,
       cast(round(l.l_extendedprice * 100) as bigint) as price_cents
from lineitem l join supplier s on l.l_suppkey = s.s_suppkey
join nation n on s.s_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey"""


def _star(spark, sf_dir, in_plan: bool) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("s_suppkey"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("price_cents"))
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey"))
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    reg = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    x = J.checked_join(li, sup, ["s_suppkey"], in_plan=in_plan)
    x = J.checked_join(x, nat, ["n_nationkey"], in_plan=in_plan)
    x = J.checked_join(x, reg, ["r_regionkey"], in_plan=in_plan)
    return x.select("l_orderkey", "l_linenumber", F.col("s_suppkey").alias("l_suppkey"), "s_name", "n_name",
                    "r_name", "price_cents")


@register("j1_star_join_checked", STAR_SQL, "J1,J3,P1")
def q_j1(spark, sf_dir):
    return _star(spark, sf_dir, in_plan=False)


@register("j3_star_join_checked_in_plan", STAR_SQL, "J1,J3")
def q_j3(spark, sf_dir):
    """The same with the key checks inside the join's own job."""
    return _star(spark, sf_dir, in_plan=True)


# ------------------------------------------------------------ J2, J4, J5
def _qualifying_side(spark, sf_dir) -> DataFrame:
    """Urgent-order quantity per supplier and ORDER month, ranked per month."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    urgent = read_table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    q = (li.join(urgent, "l_orderkey")
           .groupBy(F.col("l_suppkey").alias("driver_id"), F.year("o_orderdate").cast("int").alias("season"),
                    F.month("o_orderdate").cast("int").alias("round"))
           .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("uq")))
    return position_within(q, ["season", "round"], [("uq", False), ("driver_id", True)], "quali_pos").drop("uq")


QUALI_SQL = """q as (select driver_id, season, round,
    cast(row_number() over (partition by season, round order by uq desc, driver_id) as int) as quali_pos
  from (select l.l_suppkey as driver_id, cast(year(o.o_orderdate) as int) as season, cast(month(o.o_orderdate) as int) as round,
               sum(cast(l.l_quantity as bigint)) as uq
        from lineitem l join orders o on l.l_orderkey = o.o_orderkey where o.o_orderpriority = '1-URGENT'
        group by 1, 2, 3) t)"""
OUTER_SQL = """o as (select coalesce(p.driver_id, q.driver_id) as driver_id, coalesce(p.season, q.season) as season,
    coalesce(p.round, q.round) as round, p.position_order, q.quali_pos,
    case when p.driver_id is not null and q.driver_id is not null then 'both'
         when p.driver_id is not null then 'left_only' else 'right_only' end as _merge
  from p full outer join q on p.driver_id = q.driver_id and p.season = q.season and p.round = q.round)"""


def _outer(spark, sf_dir) -> DataFrame:
    res = base_panel(spark, sf_dir).select("driver_id", "season", "round", "position_order")
    return J.outer_with_indicator(res, _qualifying_side(spark, sf_dir), ["driver_id", "season", "round"])


@register("j4_outer_join_indicator", with_prep(QUALI_SQL, OUTER_SQL)
          + f"select * from o where _merge <> 'right_only' or season >= {LIVE}", "J2,J4,J5")
def q_j4(spark, sf_dir):
    return J.keep_right_only_for(_outer(spark, sf_dir), "season", LIVE).select(
        "driver_id", "season", "round", "position_order", "quali_pos", "_merge")


@register("j5_orphan_count", with_prep(QUALI_SQL) + f"""
select cast(count(*) as bigint) as n_orphans from q
where season <= {CLOSED_MAX} and not exists (
  select 1 from p where p.driver_id = q.driver_id and p.season = q.season and p.round = q.round)""", "J5,J9")
def q_j5(spark, sf_dir):
    res = base_panel(spark, sf_dir).select("driver_id", "season", "round")
    return J.orphan_count(res, _qualifying_side(spark, sf_dir), ["driver_id", "season", "round"],
                          F.col("season") <= CLOSED_MAX)


# ------------------------------------------------------------ J6 lookup
@register("j6_dictionary_lookup", with_prep() + """
select p.driver_id, p.season, p.round, coalesce(n.n_name, 'unknown') as constructor_name
from p left join (select n_nationkey, n_name from nation where n_nationkey < 20) n on p.constructor_id = n.n_nationkey""",
          "J6")
def q_j6(spark, sf_dir):
    nat = read_table(spark, sf_dir, "nation").filter(F.col("n_nationkey") < 20)
    x = J.lookup(base_panel(spark, sf_dir), "constructor_id", nat, "n_nationkey", "n_name", "constructor_name",
                 "unknown")
    return x.select("driver_id", "season", "round", "constructor_name")


# ------------------------------------------------------------ J8-J10 entity resolution
def _external_entities(spark, sf_dir) -> DataFrame:
    """External feed: id = lower-cased name with '#' -> '_'; every 10th
    supplier arrives under a new id (half of those keep the name, so they
    resolve by name; the other half are renamed and stay unmapped)."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    ext_id = F.when(k % 10 == 0, F.concat(F.lit("new_"), k.cast("string"))).otherwise(
        F.lower(F.regexp_replace(F.col("s_name"), "#", "_")))
    ext_name = F.when((k % 10 == 0) & (k % 20 != 0), F.concat(F.lit("Vendor "), k.cast("string"))).otherwise(
        F.col("s_name"))
    return s.select(ext_id.alias("ext_id"), ext_name.alias("ext_name"))


def _internal_entities(spark, sf_dir) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("id"), F.lower(F.regexp_replace("s_name", "#", "")).alias("ref"),
                    F.col("s_name").alias("name"))


EXT_SQL = """ext as (select case when s_suppkey % 10 = 0 then 'new_' || cast(s_suppkey as varchar)
                          else lower(replace(s_name, '#', '_')) end as external_id,
                     case when s_suppkey % 10 = 0 and s_suppkey % 20 <> 0 then 'Vendor ' || cast(s_suppkey as varchar)
                          else s_name end as external_name from supplier)"""
INT_SQL = "intl as (select s_suppkey as id, lower(replace(s_name, '#', '')) as ref, s_name as name from supplier)"
NORM = "regexp_replace(lower({}), '[^a-z0-9]+', '', 'g')"
MAP_SQL = f"""m as (select e.external_id, e.external_name,
    coalesce(r.id, n.id) as internal_id, coalesce(r.ref, n.ref) as internal_ref,
    case when coalesce(r.id, n.id) is not null then 'ref_or_normalized_name' else 'unmapped' end as match_method
  from ext e
  left join (select {NORM.format('ref')} as k, arg_min(id, id) as id, arg_min(ref, id) as ref from intl group by 1) r
    on {NORM.format('e.external_id')} = r.k
  left join (select {NORM.format('name')} as k, arg_min(id, id) as id, arg_min(ref, id) as ref from intl group by 1) n
    on {NORM.format('e.external_name')} = n.k)"""


def _mapping(spark, sf_dir) -> DataFrame:
    return J.resolve_entities(_external_entities(spark, sf_dir), _internal_entities(spark, sf_dir),
                              "ext_id", "ext_name", "id", "ref", "name")


@register("j8_entity_resolution", f"with {EXT_SQL}, {INT_SQL}, {MAP_SQL} select * from m", "J8,P14,O8")
def q_j8(spark, sf_dir):
    return _mapping(spark, sf_dir)


@register("j9_unmapped_report", f"with {EXT_SQL}, {INT_SQL}, {MAP_SQL} "
          "select external_id, external_name from m where match_method = 'unmapped'", "J9")
def q_j9(spark, sf_dir):
    return _mapping(spark, sf_dir).filter(F.col("match_method") == "unmapped").select("external_id", "external_name")


@register("j10_allocate_ids", f"with {EXT_SQL}, {INT_SQL}, {MAP_SQL} "
          "select external_id, external_name, cast(internal_id as bigint) as internal_id, internal_ref, match_method "
          "from m where match_method <> 'unmapped' union all "
          "select external_id, external_name, cast((select max(id) from intl) + row_number() over (order by external_id) "
          "as bigint), external_id, 'allocated' from m where match_method = 'unmapped'", "J10")
def q_j10(spark, sf_dir):
    return J.allocate_ids(_mapping(spark, sf_dir), _internal_entities(spark, sf_dir), "id")


# ------------------------------------------------------------ P2, P14
@register("p2_full_name", """
select s_suppkey, trim(coalesce(case when s_nationkey = 0 then null else split_part(s_name, '#', 1) end, '')
       || ' ' || coalesce(case when s_nationkey = 1 then null else split_part(s_name, '#', 2) end, '')) as full_name
from supplier""", "P2")
def q_p2(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.when(F.col("s_nationkey") == 0, F.lit(None)).otherwise(F.substring_index("s_name", "#", 1)).alias("first"),
        F.when(F.col("s_nationkey") == 1, F.lit(None)).otherwise(F.substring_index("s_name", "#", -1)).alias("last"))
    return s.select("s_suppkey", full_name("first", "last").alias("full_name"))


@register("p14_normalize_text", """
select doc_id, regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', '', 'g') as normalized
from documents""", "P14")
def q_p14(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", normalize_name(F.col("text")).alias("normalized"))


# ------------------------------------------------------------ S6-S9 nested snapshots
FLAT_RESULTS_SQL = with_prep() + """
select cast(season as varchar) as season, cast(round as varchar) as round, 'Month ' || cast(round as varchar) as raceName,
  strftime(make_date(season, round, 1), '%Y-%m-%d') as date, cast(circuit_id as varchar) as "Circuit.circuitId",
  'Venue ' || cast(round as varchar) as "Circuit.circuitName", cast(driver_id as varchar) as "Driver.driverId",
  split_part(driver_name, '#', 1) as "Driver.givenName", split_part(driver_name, '#', 2) as "Driver.familyName",
  cast(constructor_id as varchar) as "Constructor.constructorId", n.n_name as "Constructor.name",
  cast(grid as varchar) as grid, cast(position_order as varchar) as position, cast(points as varchar) as points, status
from p left join nation n on p.constructor_id = n.n_nationkey"""


def _results_pages(spark, sf_dir, limit=30) -> DataFrame:
    return SN.results_pages(base_panel(spark, sf_dir), read_table(spark, sf_dir, "nation"), limit)


@register("s7_results_flatten", FLAT_RESULTS_SQL, "S7,S9")
def q_s7(spark, sf_dir):
    return SN.flatten_results(SN.parse_pages(_results_pages(spark, sf_dir)))


@register("s6_schedule_flatten", with_prep() + """
select distinct cast(season as varchar) as season, cast(round as varchar) as round, 'Month ' || cast(round as varchar) as raceName,
  strftime(make_date(season, round, 1), '%Y-%m-%d') as date, cast(circuit_id as varchar) as "Circuit.circuitId",
  'Venue ' || cast(round as varchar) as "Circuit.circuitName" from p""", "S6")
def q_s6(spark, sf_dir):
    return SN.flatten_schedule(SN.parse_pages(_results_pages(spark, sf_dir)))


@register("s8_standings_flatten", with_prep() + """
select cast(season as varchar) as season, cast(round as varchar) as round,
  cast(row_number() over (partition by season, round order by cum desc, driver_id) as varchar) as position,
  cast(cum as varchar) as points, cast(driver_id as varchar) as "Driver.driverId",
  split_part(driver_name, '#', 1) as "Driver.givenName", split_part(driver_name, '#', 2) as "Driver.familyName"
from (select *, sum(points) over (partition by season, driver_id order by event_seq
                                  rows between unbounded preceding and current row) as cum from p) t""", "S8")
def q_s8(spark, sf_dir):
    return SN.flatten_standings(SN.parse_pages(SN.standings_pages(base_panel(spark, sf_dir))))


@register("s7_qualifying_flatten", with_prep() + """
select cast(season as varchar) as season, cast(round as varchar) as round, 'Month ' || cast(round as varchar) as raceName,
  strftime(make_date(season, round, 1), '%Y-%m-%d') as date, cast(circuit_id as varchar) as "Circuit.circuitId",
  cast(driver_id as varchar) as "Driver.driverId", cast(constructor_id as varchar) as "Constructor.constructorId",
  n.n_name as "Constructor.name", cast(quali_position as varchar) as position
from p left join nation n on p.constructor_id = n.n_nationkey where quali_position is not null""", "S7")
def q_s7q(spark, sf_dir):
    return SN.flatten_qualifying(SN.parse_pages(_qualifying_pages(spark, sf_dir)))


def _qualifying_pages(spark, sf_dir) -> DataFrame:
    return SN.qualifying_pages(base_panel(spark, sf_dir), read_table(spark, sf_dir, "nation"))


def _constructor_pages(spark, sf_dir) -> DataFrame:
    return SN.constructor_standings_pages(base_panel(spark, sf_dir), read_table(spark, sf_dir, "nation"))


@register("s8_constructor_standings_flatten", with_prep() + """
select cast(season as varchar) as season, cast(round as varchar) as round,
  cast(row_number() over (partition by season, round order by cum desc, constructor_id) as varchar) as position,
  cast(cum as varchar) as points, cast(constructor_id as varchar) as "Constructor.constructorId", n.n_name as "Constructor.name"
from (select season, round, constructor_id, sum(pts) over (partition by season, constructor_id order by event_seq
                                                           rows between unbounded preceding and current row) as cum
      from (select season, round, event_seq, constructor_id, sum(points) as pts from p group by all) g) t
left join nation n on t.constructor_id = n.n_nationkey""", "S8")
def q_s8c(spark, sf_dir):
    return SN.flatten_constructor_standings(SN.parse_pages(_constructor_pages(spark, sf_dir)))


@register("s10_snapshot_round_trip", with_prep() + """
select kind, season, cast(count(*) as bigint) as n_rows from (
  select distinct 'schedule' as kind, season, round, 0 as id from p
  union all select 'results', season, round, driver_id from p
  union all select 'qualifying', season, round, driver_id from p where quali_position is not null
  union all select 'driver_standings', season, round, driver_id from p
  union all (select distinct 'constructor_standings', season, round, constructor_id from p)) k
where season >= 1998 group by kind, season""", "S5,S10")
def q_s10(spark, sf_dir):
    """All five kinds written by season, then loaded with a season filter
    (which prunes folders) and counted."""
    import uuid
    from ..session import ensure_checkpoint_dir
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/snapshots-{uuid.uuid4().hex[:10]}"
    results = SN.parse_pages(_results_pages(spark, sf_dir))
    kinds = {"schedule": SN.flatten_schedule(results), "results": SN.flatten_results(results),
             "qualifying": SN.flatten_qualifying(SN.parse_pages(_qualifying_pages(spark, sf_dir))),
             "driver_standings": SN.flatten_standings(SN.parse_pages(SN.standings_pages(base_panel(spark, sf_dir)))),
             "constructor_standings": SN.flatten_constructor_standings(SN.parse_pages(_constructor_pages(spark, sf_dir)))}
    for kind, df in kinds.items():
        SN.write_snapshot(df.withColumn("season", F.col("season").cast("int")), root, kind)
    loaded = SN.load_snapshots(spark, root, list(kinds), list(range(1998, LIVE + 1)))
    out = None
    for kind, df in loaded.items():
        part = df.groupBy("season").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(kind).alias("kind"), "season", "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------ U1 / P16
CANONICAL = [("driver_id", "bigint"), ("season", "int"), ("round", "int"), ("constructor_id", "int"),
             ("position_order", "int"), ("grid", "int"), ("quali_position", "int"), ("points", "int"),
             ("status", "string"), ("source", "string")]


@register("u1_union_base_and_snapshot", with_prep() + f"""
select driver_id, season, round, constructor_id, position_order, grid, quali_position, points, status, 'base' as source
from p where season <= {LIVE - 2}
union all
select driver_id, season, round, constructor_id, position_order, grid, cast(null as int), points, status, 'snapshot'
from p where season >= {LIVE - 1}""", "U1,P16,U2")
def q_u1(spark, sf_dir):
    base = base_panel(spark, sf_dir).filter(F.col("season") <= LIVE - 2).withColumn("source", F.lit("base"))
    flat = SN.flatten_results(SN.parse_pages(_results_pages(spark, sf_dir)))
    snap = flat.select(
        F.col("`Driver.driverId`").cast("bigint").alias("driver_id"), F.col("season").cast("int").alias("season"),
        F.col("round").cast("int").alias("round"),
        F.col("`Constructor.constructorId`").cast("int").alias("constructor_id"),
        F.col("position").cast("int").alias("position_order"), F.col("grid").cast("int").alias("grid"),
        F.col("points").cast("int").alias("points"), "status", F.lit("snapshot").alias("source"),
    ).filter(F.col("season") >= LIVE - 1)
    return J.conform(J.union_by_name(base, snap), CANONICAL)


# ------------------------------------------------------------ T1 incremental ingest
@register("t1_incremental_ingest", FLAT_RESULTS_SQL, "T1,S9")
def q_t1(spark, sf_dir):
    from ..session import ensure_checkpoint_dir, materialize
    from ..streaming.ingest import incremental_results_ingest
    import uuid
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex[:10]}"
    pages = materialize(_results_pages(spark, sf_dir), "pages")  # built once for both deliveries
    # two deliveries: the first pages, then all pages again (re-delivered
    # pages must not duplicate rows)
    SN.write_pages(pages.filter(F.col("season") <= LIVE - 1), f"{root}/incoming/batch1")
    table = incremental_results_ingest(spark, f"{root}/incoming", f"{root}/table", f"{root}/ckpt")
    SN.write_pages(pages, f"{root}/incoming/batch2")
    table = incremental_results_ingest(spark, f"{root}/incoming", f"{root}/table", f"{root}/ckpt")
    return table.select(*[F.col(f"`{c}`").alias(c) for c in SN.RESULT_COLUMNS])


@register("t1_compacted_ingest", FLAT_RESULTS_SQL, "T1,S9")
def q_t1_compacted(spark, sf_dir):
    """Three deliveries, a compaction after each of the first two: the read
    joins the snapshot and the one epoch behind it."""
    from ..session import ensure_checkpoint_dir, materialize
    from ..streaming.ingest import compact, incremental_results_ingest
    import uuid
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex[:10]}"
    pages = materialize(_results_pages(spark, sf_dir), "pages")  # built once for all deliveries
    for i, part in enumerate((pages.filter(F.col("season") < LIVE - 2), pages.filter(F.col("season") < LIVE), pages.filter(F.col("season") >= LIVE - 1))):
        SN.write_pages(part, f"{root}/incoming/batch{i}")
        table = incremental_results_ingest(spark, f"{root}/incoming", f"{root}/table", f"{root}/ckpt")
        if i < 2:
            compact(spark, f"{root}/table")
    return table.select(*[F.col(f"`{c}`").alias(c) for c in SN.RESULT_COLUMNS])


# ------------------------------------------------------------ S2, P4 rejects
@register("s2_rejects_by_reason", """
with o as (
  select o_orderkey as k, o_orderkey % 101 = 0 as no_key, o_orderkey % 101 <> 0 and o_orderkey % 103 = 0 as bad_key,
         o_orderkey % 97 = 0 as bad_price, o_orderkey % 89 = 0 as bad_date from orders
)
select 'row' as level, null as column_name, 'missing key o_orderkey' as reason, count(*) as n from o where no_key having count(*) > 0
union all select 'row', null, 'key o_orderkey is no bigint', count(*) from o where bad_key having count(*) > 0
union all select 'value', 'o_totalprice', 'wrong type', count(*) from o where bad_price and not no_key and not bad_key having count(*) > 0
union all select 'value', 'o_orderdate', 'wrong type', count(*) from o where bad_date and not no_key and not bad_key having count(*) > 0
union all select 'kept', null, null, count(*) from o where not no_key and not bad_key""", "S2,P4")
def q_rejects(spark, sf_dir):
    """Orders as text with planted defects: rejected records, nulled values
    and kept rows."""
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType
    from ..sources import quarantine as QU
    k = F.col("o_orderkey")
    text = read_table(spark, sf_dir, "orders").select(
        F.when(k % 101 == 0, F.lit(None)).when(k % 103 == 0, F.concat(F.lit("k"), k)).otherwise(k.cast("string")).alias("o_orderkey"),
        F.when(k % 97 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(k % 89 == 0, F.lit("30 February")).otherwise(F.col("o_orderdate").cast("string")).alias("o_orderdate"), "o_orderstatus")
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_totalprice", DoubleType()), StructField("o_orderdate", TimestampType()),
                         StructField("o_orderstatus", StringType())])
    judged = QU.judge(text, schema, ["o_orderkey"])
    out = QU.rejects(judged).groupBy("level", "column_name", "reason").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("string")
    return out.unionByName(QU.totals(judged).select(F.lit("kept").alias("level"), none.alias("column_name"), none.alias("reason"), F.col("n_kept").alias("n")))


# ------------------------------------------------------------ P3, P15
@register("p3_min_season_filter", with_prep() + "select driver_id, season, round from p where season >= 1996", "P3")
def q_p3(spark, sf_dir):
    # the filter reaches the scan of the materialised panel (PushedFilters)
    return base_panel(spark, sf_dir).filter(F.col("season") >= 1996).select("driver_id", "season", "round")


@register("p15_schedule_fallback", with_prep(QUALI_SQL,
    "pr as (select driver_id, season, round, position_order, circuit_id, 'Month ' || cast(round as varchar) as race_name from p)",
    """o as (select coalesce(pr.driver_id, q.driver_id) as driver_id, coalesce(pr.season, q.season) as season,
    coalesce(pr.round, q.round) as round, pr.circuit_id, pr.race_name,
    case when pr.driver_id is not null and q.driver_id is not null then 'both'
         when pr.driver_id is not null then 'left_only' else 'right_only' end as _merge
  from pr full outer join q on pr.driver_id = q.driver_id and pr.season = q.season and pr.round = q.round)""",
    "sch as (select distinct season, round, circuit_id, 'Month ' || cast(round as varchar) as race_name from p)") + f"""
select o.driver_id, o.season, o.round, coalesce(o.circuit_id, sch.circuit_id) as circuit_id,
  coalesce(o.race_name, sch.race_name) as race_name, o._merge
from o left join sch on o.season = sch.season and o.round = sch.round
where o._merge <> 'right_only' or o.season >= {LIVE}""", "P15,D6,J4")
def q_p15(spark, sf_dir):
    b = base_panel(spark, sf_dir)
    res = b.select("driver_id", "season", "round", "position_order", "circuit_id",
                   F.concat(F.lit("Month "), F.col("round").cast("string")).alias("race_name"))
    o = J.keep_right_only_for(J.outer_with_indicator(res, _qualifying_side(spark, sf_dir),
                                                     ["driver_id", "season", "round"]), "season", LIVE)
    sch = b.select("season", "round", F.col("circuit_id").alias("_sc"),
                   F.concat(F.lit("Month "), F.col("round").cast("string")).alias("_sr")).distinct()
    o = o.join(sch, ["season", "round"], "left")  # one row per event: bounded, broadcast by AQE
    return o.select("driver_id", "season", "round", F.coalesce("circuit_id", "_sc").alias("circuit_id"),
                    F.coalesce("race_name", "_sr").alias("race_name"), "_merge")


@register("s9_page_completeness", with_prep() + f"""
select cast(season as varchar) as season, cast(count(*) as bigint) as declared_total,
  cast(count(*) - case when season = {LIVE} then least(30, count(*)) else 0 end as bigint) as received_rows,
  season <> {LIVE} as complete from p group by season having season <> {LIVE} or count(*) > 30""", "S9,D9")
def q_s9(spark, sf_dir):
    """The first page of the live season got lost on the way."""
    pages = _results_pages(spark, sf_dir).where(~((F.col("season") == LIVE) & (F.col("_page") == 0)))
    return SN.page_completeness(SN.parse_pages(pages))
