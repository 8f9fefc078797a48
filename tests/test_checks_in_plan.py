"""Key checks and counts that ride along with the data's own job."""
import pytest
from pyspark.sql import functions as F

from tallyspark.operators.joins import checked_join
from tallyspark.operators.quality import Checks, DataQualityError, unique_rows


def test_a_join_with_checks_inside_raises_when_it_runs(spark):
    left = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, a string")
    good = spark.createDataFrame([(1, "p", None), (2, None, 5), (None, "n", 1)], "k int, `b c` string, d int")
    got = checked_join(left, good, ["k"], how="left", in_plan=True)
    assert got.columns == ["k", "a", "b c", "d"]
    assert sorted(map(str, got.collect())) == sorted(map(str, checked_join(left, good, ["k"], how="left").collect()))
    twice = good.unionByName(good.limit(1))
    with pytest.raises(DataQualityError):
        checked_join(left, twice, ["k"])
    lazy = checked_join(left, twice, ["k"], in_plan=True)  # nothing has run yet
    for action in (lambda: lazy.collect(), lambda: lazy.count(), lambda: lazy.select("a").collect()):
        with pytest.raises(Exception, match="duplicate keys on"):
            action()
    with pytest.raises(Exception, match="duplicate keys on"):
        checked_join(left.unionByName(left), good, ["k"], validate="one_to_one", in_plan=True).collect()


def test_unique_rows_keeps_rows_and_may_have_keys_only(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (None, None)], "a int, b int")
    assert sorted(map(str, unique_rows(df, ["a", "b"]).collect())) == sorted(map(str, df.collect()))
    with pytest.raises(Exception, match="duplicate keys"):
        unique_rows(df, ["a"]).collect()
    assert unique_rows(df.limit(0), ["a"]).collect() == []


def test_checks_are_counted_while_the_data_passes(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i, i - 2) for i in range(10)], "id int, target int, p int")
    ok = Checks("targets", negative_id=F.col("id") < 0)
    ok.watch(df).write.parquet(str(tmp_path / "a"))
    assert ok.verify() == {"n_rows": 10, "negative_id": 0}
    bad = Checks("targets", missing=F.col("target").isNull(), negative=F.col("p") < 0)
    bad.watch(df).write.parquet(str(tmp_path / "b"))
    with pytest.raises(DataQualityError, match=r"'missing': 3, 'negative': 2.* of 10 rows"):
        bad.verify()
    none = Checks("empty", missing=F.col("target").isNull())
    none.watch(df.limit(0)).write.parquet(str(tmp_path / "c"))
    assert none.verify() == {"n_rows": 0, "missing": 0}
