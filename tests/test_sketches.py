"""Merged sketches against exact profiles."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.operators import sketches as SK
from tallyspark.operators.profile import column_profile

COLS = ["id", "name", "x", "rare", "none", "flag"]


@pytest.fixture(scope="module")
def data(spark):
    n = F.col("id")
    return spark.range(40_000).select(
        F.when(n % 5 != 0, (n * 7919) % 30_011).alias("id"), F.concat(F.lit("n"), n % 1234).alias("name"), F.when(n % 3 != 0, F.sqrt(n)).alias("x"),
        F.when(n == 77, n).cast("int").alias("rare"), F.lit(None).cast("double").alias("none"), (n % 2 == 0).alias("flag"), (n % 4).cast("int").alias("season")).cache()


def test_merged_parts_are_within_the_error_bound(spark, data):
    got = {r.column_name: r for r in SK.merged_profile(SK.profile_sketches(data, "season", COLS)).collect()}
    exact = {r.column_name: r for r in column_profile(data, COLS).collect()}
    assert set(got) == set(COLS)
    for c, r in got.items():
        assert (r.n_rows, r.null_count, r.null_rate) == (40_000, exact[c].null_count, exact[c].null_rate)
        assert abs(r.n_distinct - exact[c].n_distinct) <= 3 * 1.04 / 2 ** 7 * exact[c].n_distinct
    x = np.sqrt(np.array([i for i in range(40_000) if i % 3]))
    for q in (25, 50, 75):  # the rank of the estimate is within 3 % of the asked one
        assert abs((x <= got["x"][f"q{q}"]).mean() - q / 100) <= 0.03
    assert got["rare"].q50 == 77 and got["none"].q50 is None and got["name"].q50 is None and got["flag"].q25 is None


def test_a_new_season_is_added_without_reading_the_others(spark, data, tmp_path):
    path = str(tmp_path / "profile")
    SK.store_profile(data.where("season < 3"), path, "season", COLS)
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "profile").glob("part=*/*.parquet")}
    SK.store_profile(data.where("season = 3"), path, "season", COLS)
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "profile").glob("part=*/*.parquet")}
    assert before.items() <= after.items() and len(after) > len(before)
    whole = {r.column_name: r for r in SK.merged_profile(SK.profile_sketches(data, "season", COLS)).collect()}
    kept = {r.column_name: r for r in SK.merged_profile(SK.read_profile(spark, path)).collect()}
    for c in COLS:
        assert (kept[c].n_rows, kept[c].null_count, kept[c].n_distinct) == (whole[c].n_rows, whole[c].null_count, whole[c].n_distinct)
    SK.store_profile(data.where("season = 3 AND id IS NOT NULL"), path, "season", COLS)  # delivered anew: replaced
    assert SK.merged_profile(SK.read_profile(spark, path)).where("column_name = 'id'").first().n_rows == data.where("season < 3 OR id IS NOT NULL").count()


def test_null_parts_and_empty_tables(spark, data):
    odd = data.withColumn("season", F.when(F.col("season") > 0, F.col("season"))).where("season IS NULL OR season = 1")
    assert SK.profile_sketches(odd, "season", ["id"]).count() == 2
    assert SK.merged_profile(SK.profile_sketches(data.limit(0), "season", COLS)).count() == 0
