"""T1 under retries and re-deliveries, called batch by batch."""
import json
import os

from pyspark.sql import functions as F

from tallyspark.sources import snapshots as SN
from tallyspark.streaming import ingest
from tallyspark.streaming.ingest import append_epoch, read_latest


def pages(spark, *docs):
    rows = []
    for offset, minute, results in docs:
        races = [{"season": "2001", "round": "1", "raceName": "Month 1", "date": "2001-01-01", "Circuit": {"circuitId": "1", "circuitName": "V"},
                  "Results": [{"position": "1", "points": str(p), "grid": "1", "status": "Finished", "Driver": {"driverId": d, "givenName": "A", "familyName": d},
                               "Constructor": {"constructorId": "3", "name": "X"}} for d, p in results]}]
        rows.append((json.dumps({"MRData": {"total": "9", "limit": "30", "offset": str(offset), "RaceTable": {"season": "2001", "Races": races}}}),
                     f"2001-01-01 00:{minute:02d}:00"))
    df = spark.createDataFrame(rows, "json string, t string")
    return df.select(F.from_json("json", SN.PAGE).alias("p"), F.to_timestamp("t").alias("_file_time")).select("p.*", "_file_time")


def table(spark, path):
    return sorted((r["Driver.driverId"] or "-", r["points"]) for r in read_latest(spark, path).collect())


def test_a_retried_epoch_loses_nothing(spark, tmp_path):
    run = append_epoch(str(tmp_path / "t"))
    run(pages(spark, (0, 1, [("a", 1), ("b", 2)])), 0)
    run(pages(spark, (0, 2, [("c", 3)])), 1)
    run(pages(spark, (0, 2, [("c", 3)])), 1)  # stopped between write and commit
    assert table(spark, str(tmp_path / "t")) == [("a", "1"), ("b", "2"), ("c", "3")]


def test_the_latest_version_of_a_key_wins(spark, tmp_path):
    run = append_epoch(str(tmp_path / "t"))
    run(pages(spark, (30, 5, [("a", 25)]), (0, 5, [("a", 10)]), (60, 1, [("a", 99)]), (0, 1, [(None, 7)]), (0, 2, [(None, 8)])), 9)
    assert table(spark, str(tmp_path / "t")) == [("-", "8"), ("a", "25")]
    run(pages(spark, (0, 0, [("a", 1)])), 10)  # a later epoch beats file times; 10 is after 9
    assert table(spark, str(tmp_path / "t")) == [("-", "8"), ("a", "1")]


def test_no_table_yet(spark, tmp_path):
    assert table(spark, str(tmp_path / "none")) == []


# ------------------------------------------------------------------ compaction
def season(df, value):
    """The pages with another season in them."""
    races = F.transform("MRData.RaceTable.Races", lambda r: r.withField("season", F.lit(value).cast("string")))
    return df.withColumn("MRData", F.col("MRData").withField("RaceTable", F.col("MRData.RaceTable").withField("Races", races)))


def folders(path):
    return sorted(str(p.relative_to(path)) for p in path.glob("epoch=*")) + sorted(str(p.relative_to(path)) for p in path.glob("_snapshots/*/*=*"))


def test_reads_are_the_same_after_every_step_of_a_compaction(spark, tmp_path):
    path, run = str(tmp_path / "t"), append_epoch(str(tmp_path / "t"))
    run(pages(spark, (0, 1, [("a", 1), ("b", 2), (None, 9)])), 0)
    run(season(pages(spark, (0, 2, [("a", 5)])), None), 1)
    run(pages(spark, (0, 3, [("b", 3)])), 2)
    want = table(spark, path)
    assert len(want) == 4 and ("b", "3") in want
    first = ingest.write_snapshot(spark, path)          # a crash here: a folder that nothing names
    assert table(spark, path) == want and ingest.manifest(spark, path)["through"] == -1
    again = ingest.write_snapshot(spark, path)          # the next compaction starts anew
    assert again["parts"] != first["parts"] and set(again["parts"]) == {"s", "s2001"} and again["through"] == 2
    ingest.publish_manifest(spark, path, again)         # a crash here: epochs are read from the snapshot alone
    assert table(spark, path) == want
    run(pages(spark, (0, 3, [("b", 3)])), 2)            # an epoch that is retried after it was folded in
    assert table(spark, path) == want
    assert ingest.clean(spark, path) == 2               # the first try's two folders; epochs stay for readers of the old manifest
    assert table(spark, path) == want and len(folders(tmp_path / "t")) == 5
    run(pages(spark, (0, 0, [("a", 7), ("c", 8)])), 3)
    want = sorted([("a", "5"), ("a", "7"), ("b", "3"), ("-", "9"), ("c", "8")])
    assert table(spark, path) == want
    third = ingest.compact(spark, path)
    assert table(spark, path) == want and third["parts"]["s"] == again["parts"]["s"] and third["parts"]["s2001"] != again["parts"]["s2001"]
    assert ingest.finished_epochs(spark, path, -1) == [3] and ingest.compact(spark, path) == third
    (tmp_path / "t" / "epoch=4").mkdir()                # an epoch whose write has not finished
    assert table(spark, path) == want


def test_a_read_does_not_grow_with_the_epochs(spark, tmp_path):
    path, run = str(tmp_path / "t"), append_epoch(str(tmp_path / "t"))
    files = []
    for e in range(6):
        run(pages(spark, (0, e, [("a", e), ("b", e)])), e)
        ingest.compact(spark, path)
        files.append(len(read_latest(spark, path).inputFiles()))
    assert table(spark, path) == [("a", "5"), ("b", "5")]
    assert max(files) <= 8 and files[-1] <= files[0] and len(ingest.finished_epochs(spark, path, -1)) == 1
    assert "Aggregate" not in read_latest(spark, path)._jdf.queryExecution().executedPlan().toString()


def test_changes_are_passed_on_and_late_rows_counted(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()

    def deliver(name, minute, results):
        body = pages(spark, (0, 0, results)).drop("_file_time").toJSON().collect()
        (incoming / name).write_text("\n".join(body))
        os.utime(incoming / name, (1_000_000_000 + 60 * minute,) * 2)
        got, late = ingest.ingest_changes(spark, str(incoming), str(tmp_path / "t"), str(tmp_path / "ck"), "30 minutes")
        rows = sorted((r["Driver.driverId"] or "-", r["points"]) for r in got.collect())
        log = ingest._epochs(spark, str(tmp_path / "t"), ingest.finished_epochs(spark, str(tmp_path / "t"), -1)).count()
        return rows, log, late

    assert deliver("1.json", 0, [("a", 1), ("b", 2), (None, 3)]) == ([("-", "3"), ("a", "1"), ("b", "2")], 3, 0)
    # the same again, one changed: only that one is logged
    assert deliver("2.json", 5, [("a", 1), ("b", 4), (None, 3)]) == ([("-", "3"), ("a", "1"), ("b", "4")], 4, 0)
    # an older version within the watermark changes nothing
    assert deliver("3.json", 2, [("b", 99)]) == ([("-", "3"), ("a", "1"), ("b", "4")], 4, 0)
    assert deliver("4.json", 90, [("c", 5)]) == ([("-", "3"), ("a", "1"), ("b", "4"), ("c", "5")], 5, 0)
    # older than 30 minutes before the newest file: dropped and counted
    assert deliver("5.json", 20, [("d", 6), ("e", 7)]) == ([("-", "3"), ("a", "1"), ("b", "4"), ("c", "5")], 5, 2)


def test_a_read_aggregates_touched_seasons_only(spark, tmp_path):
    path, run = str(tmp_path / "t"), append_epoch(str(tmp_path / "t"))
    run(pages(spark, (0, 1, [("a", 1)])), 0)
    for e, s in enumerate(("1999", None, "2000"), 1):
        run(season(pages(spark, (0, 1, [("a", e + 1), (None, e)])), s), e)
    folders = ingest.compact(spark, path)["parts"]
    run(pages(spark, (0, 2, [("a", 9), ("b", 3)])), 4)
    got = read_latest(spark, path)
    assert sorted((r["season"] or "-", r["Driver.driverId"] or "-", r["points"]) for r in got.collect()) == [
        ("-", "-", "2"), ("-", "a", "3"), ("1999", "-", "1"), ("1999", "a", "2"), ("2000", "-", "3"), ("2000", "a", "4"), ("2001", "a", "9"), ("2001", "b", "3")]
    plan = got._jdf.queryExecution().optimizedPlan()
    below = [plan.children().apply(i).toString() for i in range(plan.children().size())]
    assert plan.nodeName() == "Union" and ["Aggregate" in x for x in below] == [True, False] and len(folders) == 4
