"""Running totals: one plan, whatever the groups, ties and keys."""
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tallyspark.operators.ordered import position_within, prefix_sums
from tallyspark import session
from tallyspark.session import drop_stages


def plain(rows, group, order):
    out = {}
    key = lambda r: [((v is not None) if up else (v is None), v if v is None or up else -v) for v, up in order(r)]
    for _, part in itertools.groupby(sorted(rows, key=lambda r: (group(r) is not None, group(r) or "", key(r))), key=group):
        total = 0
        for i, r in enumerate(part, 1):
            total += r[2] or 0
            out[r[3]] = (total, i)
    return out


@pytest.mark.parametrize("shape", ["null_groups", "ties", "one_group"])
def test_totals_with_null_groups_ties_and_one_large_group(spark, shape):
    rng = random.Random(1)
    groups = {"null_groups": [None, "a", "b"], "ties": ["a", "b"], "one_group": ["a"]}[shape]
    rows = [(rng.choice(groups), (0 if rng.random() < 0.99 else rng.randrange(9)) if shape == "ties" else rng.choice([None, *range(40)]),
             rng.choice([None, 1, 5]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, o int, v int, id int")  # in memory, nullable order column
    got = prefix_sums(df, ["g"], [("o", False), ("id", True)], ["v"], with_position="pos")
    assert got.columns == ["g", "o", "v", "id", "cum_v", "pos"]
    assert {r.id: (r.cum_v, r.pos) for r in got.collect()} == plain(rows, lambda r: r[0], lambda r: [(r[1], False), (r[3], True)])


def test_positions_of_keys_with_a_long_common_prefix_and_even_parts(spark):
    df = spark.range(20_000).select(F.format_string("supplier_000000000%08d", "id").alias("k"), "id")
    got = position_within(df, [], [("k", True)], "pos")
    assert got.where(F.col("pos") != F.col("id") + 1).count() == 0
    same = spark.range(20_000).select(F.lit("event").alias("g"), F.lit(0).alias("o"), "id")  # every row ties
    x = same.repartitionByRange(8, "g", F.col("o").desc(), F.col("id").asc()).groupBy(F.spark_partition_id()).count()
    sizes = [r["count"] for r in x.collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * sum(sizes) / 8
    assert position_within(same, ["g"], [("o", False), ("id", True)], "pos").where(F.col("pos") != F.col("id") + 1).count() == 0


def test_no_rows(spark):
    df = spark.createDataFrame([], "g string, o int, v int")
    assert prefix_sums(df, ["g"], [("o", True)], ["v"], with_position="p").collect() == []


def test_stage_tables_can_be_dropped(spark, monkeypatch):
    monkeypatch.setattr(session, "_STAGES", {})  # other tests still read theirs
    position_within(spark.range(5), [], [("id", True)], "p").count()
    assert drop_stages(spark) > 0 and drop_stages(spark) == 0


def test_positions_move_and_write_only_what_is_ranked(spark):
    """The rows of a part are numbered as they are written: no window over
    them, and columns that aren't asked for are not written."""
    df = spark.range(500).select((F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("v"), "id", F.lit("x" * 50).alias("wide"))
    got = position_within(df, ["g"], [("v", False), ("id", True)], "pos", keep=["id"])
    assert got.columns == ["g", "id", "pos"]
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    rows = sorted((r["g"], -(r["id"] % 7), r["id"], r["pos"]) for r in got.collect())
    for g in range(3):
        assert [r[3] for r in rows if r[0] == g] == list(range(1, 1 + len([r for r in rows if r[0] == g])))
    assert len(rows) == 500


def test_positions_of_null_and_tied_groups(spark):
    df = spark.range(200).select(F.when(F.col("id") % 2 == 0, F.lit("a")).alias("g"), F.lit(1).alias("v"), "id").repartition(7)
    got = {r["id"]: r["pos"] for r in position_within(df, ["g"], [("v", True), ("id", True)], "pos").collect()}
    assert got == {i: i // 2 + 1 for i in range(200)}
