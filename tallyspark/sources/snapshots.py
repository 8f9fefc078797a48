"""Nested JSON snapshots (S5-S10): pages of ``MRData`` documents.

Page layout (scalars are strings, as served by the public results API):
``MRData{total, limit, offset, RaceTable{season, Races[]{season, round,
raceName, date, Circuit{circuitId, circuitName}, Results[]{position, points,
grid, status, Driver{driverId, givenName, familyName}, Constructor{
constructorId, name}}}}}`` and ``StandingsTable{StandingsLists[]{season,
round, DriverStandings[]{position, points, Driver{...}}}}``.

Reading is ``from_json``/``read.json`` with an explicit schema and two
``inline`` generators; rows of a race split over several pages simply
append.  Writing (used to produce fixture pages from the panel) paginates a
season by a distributed running offset, so every page is a bounded group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..operators.ordered import position_within


def _s(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


DRIVER = StructType(_s("driverId", "givenName", "familyName"))
CONSTRUCTOR = StructType(_s("constructorId", "name"))
CIRCUIT = StructType(_s("circuitId", "circuitName"))
RESULT = StructType(_s("position", "points", "grid", "status")
                    + [StructField("Driver", DRIVER), StructField("Constructor", CONSTRUCTOR)])
QUALIFYING = StructType(_s("position") + [StructField("Driver", DRIVER), StructField("Constructor", CONSTRUCTOR)])
RACE = StructType(_s("season", "round", "raceName", "date")
                  + [StructField("Circuit", CIRCUIT), StructField("Results", ArrayType(RESULT)),
                     StructField("QualifyingResults", ArrayType(QUALIFYING))])
STANDING = StructType(_s("position", "points") + [StructField("Driver", DRIVER)])
CONSTRUCTOR_STANDING = StructType(_s("position", "points") + [StructField("Constructor", CONSTRUCTOR)])
STANDINGS_LIST = StructType(_s("season", "round") + [
    StructField("DriverStandings", ArrayType(STANDING)),
    StructField("ConstructorStandings", ArrayType(CONSTRUCTOR_STANDING))])
PAGE = StructType([StructField("MRData", StructType(
    _s("total", "limit", "offset")
    + [StructField("RaceTable", StructType(_s("season") + [StructField("Races", ArrayType(RACE))])),
       StructField("StandingsTable", StructType(_s("season") + [
           StructField("StandingsLists", ArrayType(STANDINGS_LIST))]))]))])

RESULT_COLUMNS = ["season", "round", "raceName", "date", "Circuit.circuitId", "Circuit.circuitName",
                  "Driver.driverId", "Driver.givenName", "Driver.familyName", "Constructor.constructorId",
                  "Constructor.name", "grid", "position", "points", "status"]
QUALIFYING_COLUMNS = ["season", "round", "raceName", "date", "Circuit.circuitId", "Driver.driverId",
                      "Constructor.constructorId", "Constructor.name", "position"]


# ------------------------------------------------------------------ reading
def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Every page file under ``path`` (one JSON document per line)."""
    return spark.read.schema(PAGE).json(path)


def parse_pages(pages: DataFrame, json_col: str = "json") -> DataFrame:
    return pages.select(F.from_json(F.col(json_col), PAGE).alias("p")).select("p.*")


def flatten_results(pages: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
    """Race fields repeated on every nested result, dotted names;
    ``extra`` columns of the page (named) are carried along."""
    races = pages.select(*extra, F.inline("MRData.RaceTable.Races"))
    own = races.columns[:len(extra)]
    res = races.select(*own, "season", "round", "raceName", "date", "Circuit", F.inline("Results"))
    return res.select(*[F.col(c).alias(c) for c in RESULT_COLUMNS], *own)


def flatten_qualifying(pages: DataFrame) -> DataFrame:
    """S7 for the other nested list of a race."""
    races = pages.select(F.inline("MRData.RaceTable.Races"))
    rows = races.select("season", "round", "raceName", "date", "Circuit", F.inline("QualifyingResults"))
    return rows.select(*[F.col(c).alias(c) for c in QUALIFYING_COLUMNS])


def page_completeness(pages: DataFrame) -> DataFrame:
    """D9 guard: per season, the declared ``total`` against the results
    actually received over all pages (a page lost mid-pagination shows up as
    ``complete = false`` instead of a silently partial table)."""
    per_page = pages.select(F.col("MRData.RaceTable.season").alias("season"),
                            F.col("MRData.total").cast("bigint").alias("declared"),
                            F.aggregate(F.col("MRData.RaceTable.Races"), F.lit(0).cast("bigint"),
                                        lambda acc, r: acc + F.size(r["Results"]).cast("bigint")).alias("n"))
    return per_page.groupBy("season").agg(
        F.max("declared").alias("declared_total"), F.sum("n").alias("received_rows")
    ).withColumn("complete", F.col("declared_total") == F.col("received_rows"))


def flatten_schedule(pages: DataFrame) -> DataFrame:
    """One row per race, struct fields flattened."""
    races = pages.select(F.inline("MRData.RaceTable.Races"))
    return races.select("season", "round", "raceName", "date",
                        F.col("Circuit.circuitId").alias("Circuit.circuitId"),
                        F.col("Circuit.circuitName").alias("Circuit.circuitName")).distinct()


def flatten_standings(pages: DataFrame) -> DataFrame:
    """Standings lists exploded, list fields repeated on each entry."""
    lists = pages.select(F.inline("MRData.StandingsTable.StandingsLists"))
    st = lists.select("season", "round", F.inline("DriverStandings"))
    return st.select("season", "round", "position", "points",
                     *[F.col(f"Driver.{c}").alias(f"Driver.{c}") for c in ("driverId", "givenName", "familyName")])


def flatten_constructor_standings(pages: DataFrame) -> DataFrame:
    """S8 for constructors."""
    lists = pages.select(F.inline("MRData.StandingsTable.StandingsLists"))
    st = lists.select("season", "round", F.inline("ConstructorStandings"))
    return st.select("season", "round", "position", "points",
                     *[F.col(f"Constructor.{c}").alias(f"Constructor.{c}") for c in ("constructorId", "name")])


# ------------------------------------------------------------------ writing
def _driver_struct(name_col: str, id_col: str) -> F.Column:
    return F.struct(F.col(id_col).cast("string").alias("driverId"),
                    F.substring_index(F.col(name_col), "#", 1).alias("givenName"),
                    F.substring_index(F.col(name_col), "#", -1).alias("familyName"))


def _with_constructor(panel: DataFrame, nation: DataFrame) -> DataFrame:
    """The panel with its constructor as a struct (25 nations: a fixed-size dimension)."""
    nat = nation.select(F.col("n_nationkey").alias("constructor_id"), F.col("n_name").alias("_cname"))
    x = panel.join(F.broadcast(nat), "constructor_id", "left")
    return x.withColumn("_constructor", F.struct(F.col("constructor_id").cast("string").alias("constructorId"),
                                                 F.col("_cname").alias("name")))


def _race_pages(x: DataFrame, order: str, entry: Sequence[Column], key: str, limit: int) -> DataFrame:
    """Nest rows into paginated documents of races, entries under ``key``.

    The offset of an entry inside its season (order: round, ``order``, entity)
    is a distributed running count; ``page = offset div limit`` bounds every
    collected group by ``limit`` entries."""
    x = position_within(x, ["season"], [("round", True), (order, True), ("driver_id", True)], "_pos")
    x = x.withColumn("_offset", F.col("_pos") - 1).withColumn("_page", F.floor(F.col("_offset") / limit))
    result = F.struct(F.col("_offset").alias("_o"), *entry)
    per_race = x.groupBy("season", "_page", "round").agg(F.sort_array(F.collect_list(result)).alias("_res"))
    race = F.struct(
        F.col("round").alias("_r"),
        F.col("season").cast("string").alias("season"), F.col("round").cast("string").alias("round"),
        F.concat(F.lit("Month "), F.col("round").cast("string")).alias("raceName"),
        F.date_format(F.make_date(F.col("season"), F.col("round"), F.lit(1)), "yyyy-MM-dd").alias("date"),
        F.struct(F.col("round").cast("string").alias("circuitId"),
                 F.concat(F.lit("Venue "), F.col("round").cast("string")).alias("circuitName")).alias("Circuit"),
        F.transform("_res", lambda r: r.dropFields("_o")).alias(key))
    pages = per_race.groupBy("season", "_page").agg(F.sort_array(F.collect_list(race)).alias("_races"))
    totals = x.groupBy("season").agg(F.count(F.lit(1)).alias("_total"))
    pages = pages.join(totals, "season")
    doc = F.struct(F.struct(
        F.col("_total").cast("string").alias("total"), F.lit(str(limit)).alias("limit"),
        (F.col("_page") * limit).cast("string").alias("offset"),
        F.struct(F.col("season").cast("string").alias("season"),
                 F.transform("_races", lambda r: r.dropFields("_r")).alias("Races")).alias("RaceTable")
    ).alias("MRData"))
    return pages.select("season", "_page", F.to_json(doc).alias("json"))


def results_pages(panel: DataFrame, nation: DataFrame, limit: int = 30) -> DataFrame:
    """Result documents of a panel (one JSON per page)."""
    return _race_pages(_with_constructor(panel, nation), "position_order", [
        F.col("position_order").cast("string").alias("position"), F.col("points").cast("string").alias("points"),
        F.col("grid").cast("string").alias("grid"), F.col("status").alias("status"),
        _driver_struct("driver_name", "driver_id").alias("Driver"), F.col("_constructor").alias("Constructor")], "Results", limit)


def qualifying_pages(panel: DataFrame, nation: DataFrame, limit: int = 30) -> DataFrame:
    """Qualifying documents of a panel: the rows that have a position."""
    x = _with_constructor(panel.where("quali_position IS NOT NULL"), nation)
    return _race_pages(x, "quali_position", [
        F.col("quali_position").cast("string").alias("position"),
        _driver_struct("driver_name", "driver_id").alias("Driver"), F.col("_constructor").alias("Constructor")], "QualifyingResults", limit)


def standings_pages(panel: DataFrame, limit: int = 30) -> DataFrame:
    """Driver standings after every round (cumulative season points, rank by
    points then entity), paginated: a (season, round) list is split into
    documents of at most ``limit`` entries (``page = (rank - 1) div limit``),
    so no collected group grows with the number of entities; a reader simply
    appends the pages."""
    from pyspark.sql import Window
    w = Window.partitionBy("season", "driver_id").orderBy("event_seq").rowsBetween(Window.unboundedPreceding, 0)
    x = panel.withColumn("_cum", F.sum("points").over(w))
    return _standings_documents(x, "driver_id", _driver_struct("driver_name", "driver_id").alias("Driver"), "DriverStandings", limit)


def constructor_standings_pages(panel: DataFrame, nation: DataFrame, limit: int = 30) -> DataFrame:
    """Constructor standings after every round in which the constructor had
    an entry: cumulative points of the season on the event x group table."""
    from pyspark.sql import Window
    per = panel.groupBy("season", "round", "event_seq", "constructor_id").agg(F.sum("points").alias("_points"))
    w = Window.partitionBy("season", "constructor_id").orderBy("event_seq").rowsBetween(Window.unboundedPreceding, 0)
    x = _with_constructor(per.withColumn("_cum", F.sum("_points").over(w)), nation)
    return _standings_documents(x, "constructor_id", F.col("_constructor").alias("Constructor"), "ConstructorStandings", limit)


def _standings_documents(x: DataFrame, entity: str, who: Column, key: str, limit: int) -> DataFrame:
    x = position_within(x, ["season", "round"], [("_cum", False), (entity, True)], "_rank")
    x = x.withColumn("_page", F.floor((F.col("_rank") - 1) / limit))
    entry = F.struct(F.col("_rank").alias("_k"), F.col("_rank").cast("string").alias("position"),
                     F.col("_cum").cast("string").alias("points"), who)
    lists = x.groupBy("season", "round", "_page").agg(F.sort_array(F.collect_list(entry)).alias("_st"))
    doc = F.struct(F.struct(
        F.lit(str(limit)).alias("limit"), (F.col("_page") * limit).cast("string").alias("offset"),
        F.struct(F.col("season").cast("string").alias("season"), F.array(F.struct(
            F.col("season").cast("string").alias("season"), F.col("round").cast("string").alias("round"),
            F.transform("_st", lambda r: r.dropFields("_k")).alias(key))).alias("StandingsLists")
        ).alias("StandingsTable")).alias("MRData"))
    return lists.select("season", "round", "_page", F.to_json(doc).alias("json"))


def write_pages(pages: DataFrame, path: str) -> None:
    """One JSON document per line (the ``json`` column as text)."""
    pages.select("json").write.mode("overwrite").text(path)


def write_snapshot(df: DataFrame, path: str, kind: str) -> str:
    """Persist a snapshot kind partitioned by season."""
    out = f"{path.rstrip('/')}/{kind}"
    df.write.mode("overwrite").partitionBy("season").parquet(out)
    return out


def load_snapshots(spark: SparkSession, path: str, kinds: list[str], seasons: list[int] | None = None) -> dict[str, DataFrame]:
    """One scan per kind over all seasons; a season filter prunes
    partitions (directories) instead of reading every file."""
    out = {}
    for k in kinds:
        df = spark.read.parquet(f"{path.rstrip('/')}/{k}")
        if seasons is not None:
            df = df.filter(F.col("season").isin(seasons))
        out[k] = df
    return out
