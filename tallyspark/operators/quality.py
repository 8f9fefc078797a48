"""Data-quality operators: key checks, contract checks, leakage checks,
reconciliation and coverage (A2, A23-A25, J11, J12, S14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


class DataQualityError(AssertionError):
    pass


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A2: keys that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def duplicate_summary(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """A2: one row (check, n_rows, n_keys, n_duplicated_keys, surplus_rows).

    Partial aggregation per key first, then a global aggregate of the small
    per-key counts: no key's rows are ever gathered in one task."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    return per_key.agg(
        F.lit(label).alias("check_name"),
        F.sum("c").cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).cast("bigint").alias("n_keys"),
        F.sum(F.when(F.col("c") > 1, 1).otherwise(0)).cast("bigint").alias("n_duplicated_keys"),
        F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"),
    )


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when ``keys`` is not unique (checked without collecting rows)."""
    if not duplicate_keys(df, keys).isEmpty():
        raise DataQualityError(f"duplicate keys on {list(keys)}")


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with an assertion inside the plan that ``keys`` is unique: the
    job that reads the rows raises if it isn't, no job of its own is needed.
    One grouped aggregate; the test is a filter, so it stays in the plan
    whatever columns are read later."""
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(0)).alias("_row"))
    single = F.assert_true(F.col("_n") == 1, F.concat(F.lit(f"duplicate keys on {list(keys)}: "), F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys])))).isNull()
    return one.where(single).select(*[F.col(f"`{c}`") if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


class Checks:
    """Data-quality counts that are taken while the data passes (A2, A23-A25):
    ``watch`` adds them to a plan, the next action that runs it fills them in,
    and ``verify`` raises if one that must be 0 is not. The data is scanned
    once, for its own job."""

    def __init__(self, name: str, **must_be_zero: Column):
        self.name, self.conditions, self.observation = name, must_be_zero, Observation(name)

    def watch(self, df: DataFrame) -> DataFrame:
        counts = [F.coalesce(F.count_if(c), F.lit(0)).alias(n) for n, c in self.conditions.items()]
        return df.observe(self.observation, F.count(F.lit(1)).alias("n_rows"), *counts)

    def verify(self) -> dict[str, int]:
        """The counts of the action that has run."""
        got = dict(self.observation.get)
        bad = {n: v for n, v in got.items() if n != "n_rows" and v}
        if bad:
            raise DataQualityError(f"{self.name}: {bad} of {got['n_rows']} rows")
        return got


def leakage_report(featured: DataFrame, entity: str, seq: str,
                   first_null_cols: Sequence[str] = ("driver_avg_finish_last_5",),
                   races_before: str = "driver_races_before") -> DataFrame:
    """The first row of every entity has 0 prior races and null history.

    ``min_by`` over the entity partial-aggregates, so an entity with many
    rows costs one small buffer per task."""
    first = featured.groupBy(entity).agg(
        F.min_by(F.struct(F.col(races_before).alias("rb"),
                          *[F.col(c).alias(f"h{i}") for i, c in enumerate(first_null_cols)]),
                 F.col(seq)).alias("f"))
    bad = (F.col("f.rb") != 0)
    for i in range(len(first_null_cols)):
        bad = bad | F.col(f"f.h{i}").isNotNull()
    return first.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_entities"),
        F.sum(bad.cast("int")).cast("bigint").alias("n_violations"),
    )


def assert_no_leakage(featured: DataFrame, keys: Sequence[str], entity: str, seq: str) -> None:
    assert_unique(featured, keys)
    row = leakage_report(featured, entity, seq).first()
    if row["n_violations"]:
        raise DataQualityError("current event leaked into rolling history")


def missing_targets(df: DataFrame, season: str, closed_before: int,
                    targets: Sequence[str]) -> DataFrame:
    """Rows of closed seasons with a null target."""
    any_null = F.lit(False)
    for t in targets:
        any_null = any_null | F.col(t).isNull()
    return df.filter((F.col(season) < closed_before) & any_null)


def contract_checks(pred: DataFrame, expected_rows: int, unique_col: str,
                    proba_cols: Sequence[str], nonneg_cols: Sequence[str],
                    order_col: str, rank_col: str, mode_col: str,
                    modes: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Contract of a top-N prediction table as boolean columns, per
    ``by`` group (an event).  Monotonic order is checked with ``lag`` over
    the top-N rows of a group (at most N rows per window partition)."""
    w = Window.partitionBy(*by).orderBy(rank_col) if by else Window.orderBy(rank_col)
    x = pred.withColumn("_prev", F.lag(order_col).over(w))
    checks: list[Column] = [
        (F.count(F.lit(1)) == expected_rows).alias("row_count_ok"),
        (F.count_distinct(unique_col) == F.count(F.lit(1))).alias("unique_ok"),
    ]
    prob_ok = F.lit(True)
    for c in proba_cols:
        prob_ok = prob_ok & F.coalesce(F.bool_and(F.col(c).between(0.0, 1.0)), F.lit(True))
    checks.append(prob_ok.alias("probabilities_ok"))
    nn = F.lit(True)
    for c in nonneg_cols:
        nn = nn & F.coalesce(F.bool_and(F.col(c) >= 0), F.lit(True))
    checks.append(nn.alias("non_negative_ok"))
    checks.append(F.coalesce(F.bool_and(F.col("_prev").isNull() | (F.col(order_col) <= F.col("_prev"))),
                             F.lit(True)).alias("order_ok"))
    checks.append(F.coalesce(F.bool_and(F.col(mode_col).isin(list(modes))), F.lit(True)).alias("mode_ok"))
    return x.groupBy(*by).agg(*checks)


def reconcile(reconstructed: DataFrame, official: DataFrame, keys: Sequence[str],
              value: str, official_value: str, tolerance: float = 0.01) -> DataFrame:
    """Full outer join by keys, difference column, rows beyond tolerance."""
    j = reconstructed.join(official, list(keys), "full")
    j = j.withColumn("difference", F.col(value) - F.col(official_value))
    return j.filter(F.abs(F.coalesce(F.col("difference"), F.lit(0.0))) > tolerance)


def coverage_flag(schedule: DataFrame, completed: DataFrame, keys: Sequence[str],
                  flag: str = "completed") -> DataFrame:
    """Flag each schedule row whose keys appear in ``completed`` (semi
    join expressed as a left join of the distinct completed keys)."""
    done = completed.select(*keys).distinct().withColumn(flag, F.lit(1))
    return (schedule.join(done, list(keys), "left")
                    .withColumn(flag, F.coalesce(F.col(flag), F.lit(0))))


def absent_rows(schedule: DataFrame, completed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Schedule rows with no completed counterpart (anti join)."""
    return schedule.join(completed.select(*keys), list(keys), "left_anti")


def snapshot_coverage(kinds: dict[str, DataFrame], season: str, round_: str) -> DataFrame:
    """Rows and distinct rounds per (season, kind)."""
    parts = [df.select(F.col(season).alias("season"), F.col(round_).alias("round"))
               .withColumn("kind", F.lit(k)) for k, df in kinds.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("season", "kind").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count_distinct("round").cast("bigint").alias("n_rounds"))
