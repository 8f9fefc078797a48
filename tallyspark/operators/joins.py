"""Join operators.

Joins are plain equi-joins; Catalyst + AQE pick broadcast or sort-merge from
runtime sizes.  ``checked_join`` adds the m:1 validation of the original
(right key unique) as a small grouped aggregate on the dimension only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import normalize_name
from .ordered import position_within, with_scalar
from .quality import DataQualityError, duplicate_keys, unique_rows


def checked_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                 validate: str = "many_to_one", in_plan: bool = False) -> DataFrame:
    """Equi-join with cardinality validation.

    ``many_to_one`` checks that the right key is unique: a grouped count of
    the dimension (partial aggregation) and a non-empty probe; the fact side
    is never scanned for the check. ``in_plan`` puts the check into the join's
    own job, which then raises, instead of running it first."""
    if in_plan:
        left = unique_rows(left, on) if validate == "one_to_one" else left
        return left.join(unique_rows(right, on), list(on), how)
    if validate in ("many_to_one", "one_to_one") and not duplicate_keys(right, on).isEmpty():
        raise DataQualityError(f"right side of join is not unique on {list(on)}")
    if validate == "one_to_one" and not duplicate_keys(left, on).isEmpty():
        raise DataQualityError(f"left side of join is not unique on {list(on)}")
    return left.join(right, list(on), how)


def outer_with_indicator(left: DataFrame, right: DataFrame, on: Sequence[str],
                         indicator: str = "_merge") -> DataFrame:
    """Full outer join with provenance: both / left_only / right_only."""
    lm = left.withColumn("_in_left", F.lit(True))
    rm = right.withColumn("_in_right", F.lit(True))
    j = lm.join(rm, list(on), "full")
    ind = (F.when(F.col("_in_left") & F.col("_in_right"), "both")
            .when(F.col("_in_left"), "left_only").otherwise("right_only"))
    return j.withColumn(indicator, ind).drop("_in_left", "_in_right")


def keep_right_only_for(df: DataFrame, season_col: str, live_season: int,
                        indicator: str = "_merge") -> DataFrame:
    """Right-only rows are dropped for closed seasons, kept for the live one."""
    return df.filter((F.col(indicator) != "right_only") | (F.col(season_col) >= live_season))


def orphan_count(left: DataFrame, right: DataFrame, on: Sequence[str], where=None) -> DataFrame:
    """Right rows without a left partner (anti join), counted."""
    r = right if where is None else right.filter(where)
    return r.join(left.select(*on), list(on), "left_anti").agg(F.count(F.lit(1)).cast("bigint").alias("n_orphans"))


def lookup(df: DataFrame, key: str, mapping: DataFrame, map_key: str, map_value: str, out: str,
           default=None, order_col: str | None = None) -> DataFrame:
    """Dictionary lookup as a left join with a de-duplicated map (the last
    entry by ``order_col`` wins, as with a Python dict); missing keys get
    ``default``."""
    m = mapping.select(F.col(map_key).alias("_mk"), F.col(map_value).alias("_mv"),
                       *( [F.col(order_col).alias("_mo")] if order_col else []))
    if order_col:
        m = m.groupBy("_mk").agg(F.max_by("_mv", "_mo").alias("_mv"))
    else:  # no order given: a deterministic choice among duplicate keys
        m = m.groupBy("_mk").agg(F.max("_mv").alias("_mv"))
    x = df.join(m, df[key] == m["_mk"], "left").drop("_mk")
    val = F.col("_mv") if default is None else F.coalesce(F.col("_mv"), F.lit(default))
    return x.withColumn(out, val).drop("_mv")


def resolve_entities(external: DataFrame, internal: DataFrame, ext_id: str, ext_name: str,
                     int_id: str, int_ref: str, int_name: str, normalizer=normalize_name) -> DataFrame:
    """Map external entities to internal ids: normalised reference match,
    else normalised name match, else ``unmapped``; one row per external id.

    Two left joins on normalised keys (the internal side de-duplicated per
    key, lowest id wins) and a ``coalesce``; no Python loop."""
    ext = (external.groupBy(F.col(ext_id).alias("external_id"))
                   .agg(F.min(ext_name).alias("external_name"))  # one row per external id, deterministic
                   .withColumns({"_nref": normalizer(F.col("external_id")),
                                 "_nname": normalizer(F.col("external_name"))}))
    intl = internal.select(F.col(int_id).alias("_iid"), F.col(int_ref).alias("_iref"),
                           normalizer(F.col(int_ref)).alias("_kref"), normalizer(F.col(int_name)).alias("_kname"))
    by_ref = intl.groupBy("_kref").agg(F.min_by(F.struct("_iid", "_iref"), "_iid").alias("r"))
    by_name = intl.groupBy("_kname").agg(F.min_by(F.struct("_iid", "_iref"), "_iid").alias("n"))
    j = (ext.join(by_ref, ext["_nref"] == by_ref["_kref"], "left")
            .join(by_name, ext["_nname"] == by_name["_kname"], "left"))
    hit = F.coalesce(F.col("r"), F.col("n"))
    return j.select(
        "external_id", "external_name",
        hit["_iid"].alias("internal_id"), hit["_iref"].alias("internal_ref"),
        F.when(hit.isNotNull(), F.lit("ref_or_normalized_name")).otherwise(F.lit("unmapped")).alias("match_method"))


def allocate_ids(mapping: DataFrame, internal: DataFrame, int_id: str) -> DataFrame:
    """New ids max(id)+1.. for unmapped entities in external-id order;
    the external id becomes the reference.  The order position is a
    distributed row number (``position_within``), the maximum a one-row
    scalar; allocated rows are marked ``allocated``."""
    top = internal.agg(F.max(int_id).alias("_max_id"))
    un = mapping.filter(F.col("match_method") == "unmapped")
    un = position_within(un, [], [("external_id", True)], "_pos")
    un = with_scalar(un, top).select(
        "external_id", "external_name", (F.col("_max_id") + F.col("_pos")).cast("bigint").alias("internal_id"),
        F.col("external_id").alias("internal_ref"), F.lit("allocated").alias("match_method"))
    mapped = mapping.filter(F.col("match_method") != "unmapped").withColumn(
        "internal_id", F.col("internal_id").cast("bigint"))
    return mapped.unionByName(un)


def conform(df: DataFrame, canonical: Sequence[tuple[str, str]]) -> DataFrame:
    """Select the canonical (name, type) list; absent columns are null."""
    have = set(df.columns)
    return df.select(*[(F.col(c).cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in canonical])


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union by column name, missing columns filled with nulls."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
