"""Exact running totals and positions over a global order, without a hot task.

``Window.partitionBy(g).orderBy(o)`` sends every row of a group to one task;
when one group holds a third of the data (an evaluation split, a big event)
that task does a third of the work. ``prefix_sums`` has one plan for all sizes:

1. rows are range-partitioned by all group and order columns, so that neither a
   large group nor a tie of the leading columns lands in one part, and are
   written once with their part number (the bounds are sampled, so a part must
   not be computed twice);
2. totals per (group, part) are a partial/final aggregate; their running totals
   are a window over at most groups + parts rows;
3. these come back by a null-safe join (a null group is a group), and an
   ordinary window inside (group, part) adds the local running total.

Tasks hold about 1 / parts of all rows, whatever the groups and ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

UNB = Window.unboundedPreceding


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row as scalar
    subqueries (``DataFrame.scalar()``): evaluated once, inlined into the
    projection, no join (Spark merges several of them into one subquery)."""
    return df.withColumns({c: one_row.select(F.col(f"`{c}`")).scalar() for c in one_row.columns})


def prefix_sums(df: DataFrame, group_cols: Sequence[str], order: Sequence[tuple[str, bool]],
                value_cols: Sequence[str], out_prefix: str = "cum_", with_position: str | None = None) -> DataFrame:
    """Add ``{out_prefix}{v}``: sum of ``v`` over rows of the same group that
    come at or before the row in ``order`` ((column, ascending) pairs; the
    order must be total within a group). ``with_position`` also adds the
    1-based position of the row (a distributed ``row_number``)."""
    groups = list(group_cols)
    by = [F.col(c).asc() if up else F.col(c).desc() for c, up in order]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = df.repartitionByRange(parts, *groups, *by).withColumn("_part", F.spark_partition_id())
    x = materialize(x, "ordered")

    sums = {v: F.sum(v) for v in value_cols} | ({"_rows": F.count(F.lit(1))} if with_position else {})
    totals = x.groupBy(*groups, "_part").agg(*[s.alias(f"_t_{v}") for v, s in sums.items()])
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(UNB, -1)
    start = totals.select(*[F.col(c).alias(f"_g_{c}") for c in groups], F.col("_part").alias("_p"),
                          *[F.coalesce(F.sum(f"_t_{v}").over(earlier), F.lit(0)).alias(f"_o_{v}") for v in sums])
    here = Window.partitionBy(*groups, "_part").orderBy(*by)
    cols = {f"{out_prefix}{v}": F.sum(F.coalesce(F.col(v), F.lit(0))).over(here.rowsBetween(UNB, 0)) + F.col(f"_o_{v}")
            for v in value_cols}
    if with_position:
        cols[with_position] = (F.row_number().over(here) + F.col("_o__rows")).cast("int")
    out = _with_start(x, start, groups, F.col("_part")).withColumns(cols)
    return out.select(*df.columns, *[c for c in cols if c not in df.columns])


def _with_start(x: DataFrame, start: DataFrame, groups: Sequence[str], part: Column) -> DataFrame:
    """Attach the offsets of a row's (group, part). They are written first:
    from the size of a file Spark knows that they are small enough to be
    broadcast, from their plan it would shuffle all rows."""
    start = materialize(start, "offsets")
    same = part == F.col("_p")
    for c in groups:
        same = same & x[c].eqNullSafe(F.col(f"_g_{c}"))
    return x.join(start, same, "left")


def position_within(df: DataFrame, group_cols: Sequence[str], order: Sequence[tuple[str, bool]], out: str,
                    keep: Sequence[str] | None = None) -> DataFrame:
    """Distributed ``row_number() over (partition by group order by ...)``.

    The rows of a part are numbered in sorted order as they are written, so
    that they move once; a row's position is its number less that of the first
    row of its group in the part, plus the rows of the group in earlier parts.
    ``keep``: columns to write and return beside the groups (default: all)."""
    groups = list(group_cols)
    kept = df.columns if keep is None else list(dict.fromkeys([*groups, *keep]))
    by = [F.col(c).asc() if up else F.col(c).desc() for c, up in order]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = df.repartitionByRange(parts, *groups, *by).sortWithinPartitions(*groups, *by)
    x = x.select(*kept, F.monotonically_increasing_id().alias("_id"))
    x = materialize(x, "ordered")

    part = F.shiftright("_id", 33)  # the upper bits of the number are the part
    first = x.groupBy(*groups, part.alias("_p")).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*groups).orderBy("_p").rowsBetween(UNB, -1)
    start = first.select(*[F.col(c).alias(f"_g_{c}") for c in groups], "_p",
                         (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_o"))
    x = _with_start(x, start, groups, part).withColumn(out, (F.col("_id") + F.col("_o")).cast("int"))
    return x.select(*dict.fromkeys([*kept, out]))
