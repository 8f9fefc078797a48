"""Column profiles that are kept, not recomputed.

``profile_sketches`` makes one row for each part of the data (a season) and
column: rows, nulls, an HLL sketch of the distinct values and a KLL sketch of
the numeric ones, from one aggregate (partial per task, a few kilobytes a
column). Sketches merge: the profile of the whole table is an aggregate over
seasons x columns rows, and a new season is profiled alone and added to the
stored table. The exact profile (``profile.column_profile``) expands every row
by the number of columns and reads all of the data each time.

Counts of rows and nulls are exact. Distinct counts have a relative standard
error of 1.04 / 2 ** (lg_k / 2) (0.8 % at 14), quantiles a rank error of about
1.3 % (k = 200), however often they are merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, NumericType

LG_K = 14


def _hashable(name: str, kind: DataType) -> Column:
    """A form of the column that HLL sketches take; equal values stay equal."""
    c = F.col(f"`{name}`")
    return c.cast("bigint") if isinstance(kind, IntegralType) else c.cast("string")


def profile_sketches(df: DataFrame, part: str, cols: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """part, column_name, n_rows, null_count, distinct and (numeric columns) quantiles."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        aggs += [F.count_if(x.isNull()).alias(f"n{i}"), F.hll_sketch_agg(_hashable(c, kinds[c]), F.lit(lg_k)).alias(f"d{i}")]
        # a sketch of no values isn't made
        numeric = isinstance(kinds[c], NumericType)
        aggs.append((F.kll_sketch_agg_double(x.cast("double")) if numeric else F.lit(None).cast("binary")).alias(f"q{i}"))
    wide = df.groupBy(F.col(f"`{part}`").alias("part")).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"), F.col(f"d{i}").alias("distinct"),
                              F.when(F.col(f"n{i}") < F.col("n_rows"), F.col(f"q{i}")).alias("quantiles")) for i, c in enumerate(cols)])
    return wide.select("part", "n_rows", F.inline(rows))


def merged_profile(sketches: DataFrame, digits: int = 4) -> DataFrame:
    """The profile of all parts: column_name, n_rows, null_count, null_rate,
    n_distinct (estimated) and the quartiles (estimated; null for text)."""
    one = sketches.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("null_count").alias("null_count"), F.hll_union_agg("distinct").alias("d"),
        F.kll_merge_agg_double("quantiles").alias("q"), F.count("quantiles").alias("known"))
    quartile = {f"q{p}": F.when(F.col("known") > 0, F.kll_sketch_get_quantile_double("q", F.lit(p / 100))) for p in (25, 50, 75)}
    return one.select("column_name", "n_rows", "null_count", F.round(F.try_divide(F.col("null_count").cast("double"), F.col("n_rows")), digits).alias("null_rate"),
                      F.hll_sketch_estimate("d").alias("n_distinct"), *[c.alias(n) for n, c in quartile.items()])


def store_profile(df: DataFrame, path: str, part: str, cols: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """Add the parts in ``df`` to the stored sketches; parts that are there
    already are replaced, all others stay untouched and unread."""
    profile_sketches(df, part, cols, lg_k).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    return read_profile(df.sparkSession, path)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
