"""Profiling operators.

All summaries are hash aggregates (partial + final), so a hot key only adds
rows to one small buffer per task; top-k reports use ``orderBy().limit()``,
which Spark plans as ``TakeOrderedAndProject`` (per-task top-k, then merge).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def rows_by(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    """A3."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias(name))


def distinct_sorted(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4 (sorted at the sink only)."""
    return df.select(*cols).distinct().orderBy(*cols)


def null_counts_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """A5: number of nulls per column and key."""
    return df.groupBy(*keys).agg(*[F.sum(F.col(c).isNull().cast("int")).cast("bigint").alias(f"{c}_nulls")
                                   for c in cols])


def column_profile(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True,
                   digits: int = 4) -> DataFrame:
    """Per column: type, null count, null rate, distinct non-null values.

    One aggregate pass; exact distinct counts use Spark's distinct-aggregate
    rewrite (``exact=False`` switches to HyperLogLog for very wide tables)."""
    cols = list(cols or df.columns)
    n = F.count(F.lit(1)).alias("n_rows")
    aggs: list[Column] = [n]
    for i, c in enumerate(cols):
        cc = F.col(f"`{c}`")
        aggs.append(F.sum(cc.isNull().cast("int")).alias(f"nn{i}"))
        aggs.append((F.count_distinct(cc) if exact else F.approx_count_distinct(cc)).alias(f"nd{i}"))
    one = df.agg(*aggs)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    stack = ", ".join(f"'{c}', '{types[c]}', nn{i}, nd{i}" for i, c in enumerate(cols))
    return one.selectExpr(
        "n_rows", f"stack({len(cols)}, {stack}) as (column_name, data_type, null_count, n_distinct)"
    ).select(
        "column_name", "data_type",
        F.col("null_count").cast("bigint").alias("null_count"),
        F.round(F.try_divide(F.col("null_count").cast("double"), F.col("n_rows").cast("double")),
                digits).alias("null_rate"),
        F.col("n_distinct").cast("bigint").alias("n_distinct"),
    )


def top_null_rates(profile: DataFrame, k: int = 25) -> DataFrame:
    """K highest null rates (ties by name)."""
    return profile.orderBy(F.desc("null_rate"), F.asc("column_name")).limit(k)


def feature_presence(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null rate and sample standard deviation per feature (long form).

    A row becomes one row per feature, two aggregates each: two aggregates for
    every column at once make a method that the JVM won't compile."""
    cols = list(cols)
    x = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in cols])).alias("_i", "_x"))
    found = x.groupBy("_i").agg(F.avg(F.col("_x").isNull().cast("double")).alias("null_rate"), F.stddev_samp("_x").alias("std"))
    every = df.sparkSession.createDataFrame(list(enumerate(cols)), "_i int, feature string")  # also where there are no rows
    return every.join(F.broadcast(found), "_i", "left").select("feature", "null_rate", "std")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def grouped_summary(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column],
                    order: Sequence[Column] | None = None, limit: int | None = None) -> DataFrame:
    """A9-A17 building block: grouped aggregate, optional ordered top-k."""
    out = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    if order is not None:
        out = out.orderBy(*order)
    if limit is not None:
        out = out.limit(limit)
    return out


def pairwise_correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, pairwise-complete (rows where
    either side is null are skipped), in one aggregate, long form."""
    aggs, names = [], []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            ca, cb = F.col(a).cast("double"), F.col(b).cast("double")
            both = ca.isNotNull() & cb.isNotNull()
            aggs.append(F.corr(F.when(both, ca), F.when(both, cb)).alias(f"c{i}_{j}"))
            names.append((a, b, f"c{i}_{j}"))
            if i != j:
                names.append((b, a, f"c{i}_{j}"))
    stack = ", ".join(f"'{a}', '{b}', {c}" for a, b, c in names)
    return df.agg(*aggs).selectExpr(f"stack({len(names)}, {stack}) as (col_a, col_b, corr)")


MOMENTS = ("n", "sa", "sb", "qa", "qb", "p")


def pair_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Moments of every pair of columns over the rows where both are known:
    col_a, col_b (col_a <= col_b by position), n, sums (sa, sb), sums of
    squares (qa, qb) and of products (p) of the values less ``mean_a`` and
    ``mean_b``, the columns' own means.

    One pass for any number of columns: with the known-mask M and the centred
    values X (unknown: 0) of a batch, all pairs' counts are M'M, sums X'M,
    squares (X^2)'M and products X'X. Tasks add up these d x d matrices and
    Spark sums one row per pair and task."""
    cols = list(cols)
    means = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    centre = np.array([m if m is not None else 0.0 for m in means])
    i, j = np.triu_indices(len(cols))

    def add(batches):
        total = np.zeros((len(MOMENTS), len(i)))
        for b in batches:
            x = np.stack([b.column(k).to_numpy(zero_copy_only=False) for k in range(len(cols))], 1)
            known = ~np.isnan(x)
            x, m = np.where(known, x - centre, 0.0), known.astype(float)
            s, q = x.T @ m, (x * x).T @ m
            for k, v in enumerate(((m.T @ m)[i, j], s[i, j], s[j, i], q[i, j], q[j, i], (x.T @ x)[i, j])):
                total[k] += v
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(v) for v in total]], ["i", "j", *MOMENTS])

    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{k}") for k, c in enumerate(cols)])
    parts = values.mapInArrow(add, "i int, j int, " + ", ".join(f"{m} double" for m in MOMENTS))
    summed = parts.groupBy("i", "j").agg(*[F.sum(m).alias(m) for m in MOMENTS])
    names, mean = F.lit(cols), F.lit(centre.tolist())
    return summed.select(names[F.col("i")].alias("col_a"), names[F.col("j")].alias("col_b"), F.col("n").cast("bigint").alias("n"), *MOMENTS[1:],
                         mean[F.col("i")].alias("mean_a"), mean[F.col("j")].alias("mean_b"))


def correlation_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A18 for any number of columns: col_a, col_b, n (rows where both are
    known) and Pearson's correlation over them; null where either column is
    constant there."""
    m = pair_moments(df, cols)
    n = F.col("n")
    va, vb = n * F.col("qa") - F.col("sa") ** 2, n * F.col("qb") - F.col("sb") ** 2
    varies = (va > 1e-10 * n * F.col("qa")) & (vb > 1e-10 * n * F.col("qb"))
    r = (n * F.col("p") - F.col("sa") * F.col("sb")) / F.sqrt(va * vb)
    return m.select("col_a", "col_b", "n", F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("corr"))


def quartiles_by(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Exact quartiles (linear interpolation) per class, from value
    histograms and distributed running counts (``quantiles``)."""
    from .quantiles import exact_quantiles
    return exact_quantiles(df, keys, value, [0.25, 0.5, 0.75], ["q25", "q50", "q75"])


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width histogram between min and max (last bin closed).

    The range comes from a one-row aggregate attached as a scalar."""
    v = F.col(value).cast("double")
    rng = df.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    from .ordered import with_scalar
    x = with_scalar(df.select(v.alias("_v")).filter(F.col("_v").isNotNull()), rng)
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / width * bins), F.lit(bins - 1))).cast("int")
    return (x.withColumn("bin", b).groupBy("bin", "_lo", "_hi")
             .agg(F.count(F.lit(1)).cast("bigint").alias("n"))
             .select("bin",
                     (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins).alias("bin_start"),
                     "n"))


def deterministic_sample(df: DataFrame, n: int, key: Column) -> DataFrame:
    """Reproducible sample of ``n`` rows at any partitioning: order by a
    hash-like key and take the first ``n`` (per-task top-n then merge)."""
    return df.withColumn("_sk", key).orderBy("_sk").limit(n).drop("_sk")


def most_active_timeline(df: DataFrame, entity: str, order: Sequence[str],
                         where: Column | None = None) -> DataFrame:
    """The entity with most rows (ties -> lowest id) and its rows.

    ``max_by`` over the per-entity counts yields one scalar row; the
    timeline is a semi join against it."""
    src = df if where is None else df.filter(where)
    counts = src.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.agg(F.max_by(F.col(entity), F.struct(F.col("_n"), -F.col(entity))).alias(entity))
    return src.join(F.broadcast(best), entity, "left_semi").orderBy(*order)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key in the given order.

    Implemented with ``min_by`` on a struct (an aggregate, so partial
    aggregation bounds the work per key) rather than a window."""
    cols = [c for c in df.columns if c not in keys]
    ordk = F.struct(*[o for o in order])
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*cols), ordk).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])


def unpivot_long(df: DataFrame, ids: Sequence[str], values: Sequence[str],
                 var: str = "variable", val: str = "value") -> DataFrame:
    """Melt wide -> long."""
    return df.unpivot(list(ids), list(values), var, val)


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Output rank; ``keys`` empty means a global rank (use only on
    bounded inputs such as a top-N table)."""
    w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
    return df.withColumn(name, F.row_number().over(w))
