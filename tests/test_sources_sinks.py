"""Sources, sinks and artifacts (S4, S5, S10-S13) and metadata operators
(P18, P26, U5, U6) - covered here instead of the oracle catalogue."""
import uuid

import pytest
from pyspark.sql import functions as F

from tallyspark.session import ensure_checkpoint_dir


@pytest.fixture()
def scratch(spark):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/test-{uuid.uuid4().hex[:8]}"


def test_optional_scan_yields_empty_table(spark, scratch):
    from tallyspark.sources.tables import read_optional
    df = read_optional(spark, f"{scratch}/missing", "a int, b string")
    assert df.count() == 0 and df.columns == ["a", "b"]


def test_load_tables_requires_tables(spark, sf_dir):
    from tallyspark.sources.tables import load_tables
    t = load_tables(spark, sf_dir, ["nation", "region"], optional=["nope"])
    assert set(t) == {"nation", "region"}
    with pytest.raises(FileNotFoundError):
        load_tables(spark, sf_dir, ["nation", "does_not_exist"])


def test_csv_null_marker(spark, scratch):
    from tallyspark.sources.sinks import write_table
    from tallyspark.sources.tables import load_tables
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, v string")
    write_table(df.withColumn("v", F.coalesce("v", F.lit("\\N"))).coalesce(1), f"{scratch}/t.csv", fmt="csv")
    back = load_tables(spark, scratch, ["t"], fmt="csv", schemas={"t": df.schema})["t"]
    assert sorted(back.collect(), key=lambda r: r.id)[1].v is None


def test_snapshot_partitioned_write_and_pruned_read(spark, sf_dir, scratch):
    from tallyspark.plans.panel import base_panel
    from tallyspark.sources.snapshots import load_snapshots, write_snapshot
    p = base_panel(spark, sf_dir)
    write_snapshot(p, scratch, "results")
    got = load_snapshots(spark, scratch, ["results"], seasons=[2000, 2001])["results"]
    assert got.count() == p.filter(F.col("season") >= 2000).count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_small_json_and_model_artifacts(spark, scratch):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from tallyspark.sources.sinks import load_model, load_small_json, save_model, save_small_json
    save_small_json(spark, {"top10": 0.46, "podium": 0.65}, f"{scratch}/thr")
    assert load_small_json(spark, f"{scratch}/thr") == {"podium": 0.65, "top10": 0.46}
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="f")]).fit(df)
    save_model(model, scratch, "evaluation", "top10")
    loaded = load_model(spark, scratch, "top10", ["live", "evaluation"])  # falls back to evaluation
    assert loaded.transform(df).first()["f"].toArray().tolist() == [1.0, 2.0]
    with pytest.raises(FileNotFoundError):
        load_model(spark, scratch, "podium", ["live", "evaluation"])


def test_split_parts_are_disjoint_and_feature_sets(spark, sf_dir):
    from tallyspark.operators.split import check_split, numeric_feature_columns, split_label
    from tallyspark.plans.panel import feature_panel, prepared_panel
    from tallyspark.spec import DEFAULT_SPLIT
    lab = split_label(prepared_panel(spark, sf_dir), DEFAULT_SPLIT)
    counts = check_split(lab)
    assert all(counts[k] > 0 for k in ("train", "validation", "test"))
    per = lab.groupBy("season").agg(F.count_distinct("split").alias("n")).filter("n > 1")
    assert per.count() == 0  # U5: one label per season
    fp = feature_panel(spark, sf_dir)
    diff = set(numeric_feature_columns(fp, "post_quali")) - set(numeric_feature_columns(fp, "pre_quali"))
    assert "quali_position" in diff and "grid_position" in diff  # U6
    with pytest.raises(ValueError):
        numeric_feature_columns(fp, "sometimes")


def test_fill_missing_and_strip(spark):
    from tallyspark.plans.predict import fill_missing_columns, strip_engineered
    df = spark.createDataFrame([(1, 2.0, 3.0)], "driver_id int, driver_points_last_5 double, grid double")
    out, missing = fill_missing_columns(df, ["grid", "driver_avg_finish_last_5"])
    assert missing == ["driver_avg_finish_last_5"] and out.first()["driver_avg_finish_last_5"] is None
    assert strip_engineered(df, keep=["driver_id"]).columns == ["driver_id", "grid"]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0


def test_streaming_upsert_replaces_and_dedupes(spark, scratch):
    """A re-delivered key replaces the stored row, new keys append, an
    empty trigger changes nothing."""
    from tallyspark.sources import snapshots as SN
    from tallyspark.streaming.ingest import incremental_results_ingest

    def page(points, drivers):
        races = [{"season": "2001", "round": "1", "raceName": "Month 1", "date": "2001-01-01",
                  "Circuit": {"circuitId": "1", "circuitName": "Venue 1"},
                  "Results": [{"position": str(i + 1), "points": str(points), "grid": "1", "status": "Finished",
                               "Driver": {"driverId": d, "givenName": "A", "familyName": d},
                               "Constructor": {"constructorId": "3", "name": "X"}} for i, d in enumerate(drivers)]}]
        import json
        return json.dumps({"MRData": {"total": str(len(drivers)), "limit": "30", "offset": "0",
                                      "RaceTable": {"season": "2001", "Races": races}}})
    inc, table, ck = f"{scratch}/incoming", f"{scratch}/table", f"{scratch}/ckpt"
    spark.createDataFrame([(page(10, ["a", "b"]),)], "value string").write.text(f"{inc}/b1")
    t1 = incremental_results_ingest(spark, inc, table, ck)
    assert sorted((r["Driver.driverId"], r["points"]) for r in t1.collect()) == [("a", "10"), ("b", "10")]
    spark.createDataFrame([(page(25, ["b", "c"]),)], "value string").write.text(f"{inc}/b2")
    t2 = incremental_results_ingest(spark, inc, table, ck)
    assert sorted((r["Driver.driverId"], r["points"]) for r in t2.collect()) == [("a", "10"), ("b", "25"), ("c", "25")]
    t3 = incremental_results_ingest(spark, inc, table, ck)  # nothing new
    assert t3.count() == 3


def test_prediction_from_saved_families(spark, scratch):
    """Train, save, load and predict one event: live family first, else evaluation."""
    from pyspark.sql import functions as F
    from tallyspark.operators.future import event_schedule
    from tallyspark.operators.models import TreeParams
    from tallyspark.plans.artifacts import load_family, save_family, train_live_family
    from tallyspark.plans.evaluate import evaluate_family
    from tallyspark.plans.panel import feature_panel, prepared_panel
    from tallyspark.plans.predict import predict_event
    from tallyspark.spec import DEFAULT_SPEC as S
    sf, few = "/root/testdata/sf0.01", TreeParams(n_trees=2, learning_rate=0.3)
    panel, root = feature_panel(spark, sf), f"{scratch}/families"
    fam, thr, _ = evaluate_family(panel, "pre_quali", few)
    save_family(spark, fam, {r["task"]: r["threshold"] for r in thr.collect()}, root, "evaluation", "pre_quali", {"season": 1998, "round": None})
    loaded, doc = load_family(spark, root, "pre_quali")
    assert doc["family"] == "evaluation" and set(doc["thresholds"]) == {"top10", "podium"} and loaded.features == fam.features
    live, thr = train_live_family(panel, "pre_quali", few, cutoff_round=6)
    save_family(spark, live, {r["task"]: r["threshold"] for r in thr.collect()}, root, "live", "pre_quali", {"season": 2001, "round": 6})
    assert load_family(spark, root, "pre_quali")[1]["trained_to"] == {"season": 2001, "round": 6}
    prep = prepared_panel(spark, sf)
    out = predict_event(prep, event_schedule(prep, S), S, 2001, 7, artifacts=root).collect()
    assert sorted(r.predicted_rank for r in out) == list(range(1, 11)) and len({r.driver_id for r in out}) == 10
    assert {r.model_family for r in out} == {"live"} and {r.prediction_mode for r in out} == {"PRE-QUALI"}
    assert all(0 <= r.proba_top10 <= 1 and 0 <= r.proba_podium <= 1 and r.expected_points >= 0 for r in out)
    scores = [r.race_rank_score for r in sorted(out, key=lambda r: r.predicted_rank)]
    assert scores == sorted(scores, reverse=True) and out[0].cutoff_round == 7 and out[0].entrants >= 10
    with pytest.raises(FileNotFoundError):
        load_family(spark, root, "post_quali")


def test_a_null_score_never_beats_a_score(spark):
    from tallyspark.operators.rank import predict_top_n
    df = spark.createDataFrame([(1, 1, "a", None, 1.0, 0.1, 0.1), (1, 1, "a", 9.0, 1.0, 0.1, 0.1), (1, 1, "b", 5.0, 1.0, 0.1, 0.1), (1, 1, "c", None, 9.0, 0.9, 0.9),
                                (1, 1, "c", None, 2.0, 0.9, 0.9)],
                               "season int, round int, driver_id string, race_rank_score double, expected_points double, proba_podium double, proba_top10 double")
    got = [(r.predicted_rank, r.driver_id, r.race_rank_score, r.expected_points) for r in predict_top_n(df, ["season", "round"], "driver_id", 3).collect()]
    assert sorted(got) == [(1, "a", 9.0, 1.0), (2, "b", 5.0, 1.0), (3, "c", None, 9.0)]


def test_text_numbers_are_coerced(spark):
    from tallyspark.functions.columns import clean_base
    from tallyspark.spec import DEFAULT_SPEC as S
    df = spark.createDataFrame([("2001", "3", "4", "x", "1", "2.5"), ("bad", None, "0", "7", "", "n/a")], "season string, round string, grid string, quali_position string, position_order string, points string")
    rows = [r.asDict() for r in clean_base(df, S).collect()]
    assert rows[0]["season"] == 2001 and rows[0]["quali_position"] is None and rows[0]["missing_qualifying"] == 1 and rows[0]["points"] == 2.5
    assert rows[1]["season"] is None and rows[1]["grid_position"] is None and rows[1]["position_order"] is None and rows[1]["points"] is None


def test_line_items_are_shuffled_with_one_number_for_the_month(spark):
    """Year and month, null and December included, survive the number; they used to be two columns of each shuffle."""
    import datetime as dt

    from tallyspark.sources.fixture import monthly_supplier_aggregate
    day = lambda y, m: y and dt.datetime(y, m, 28, 23, 59)
    rows = [(1, 7, day(1995, 12), 10.005, 2.0, "R", "F"), (2, 7, day(1995, 12), 1.0, 3.0, "N", "O"), (1, 7, day(1996, 1), 2.0, 4.0, "N", "F"),
            (3, 7, day(None, 0), 5.0, 5.0, "N", "F"), (1, 7, day(None, 0), 5.0, 6.0, "N", "F"), (1, None, day(1996, 1), 2.5, 7.0, "R", "O")]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_shipdate timestamp_ntz, l_extendedprice double, l_quantity double, l_returnflag string, l_linestatus string")
    orders = spark.createDataFrame([(1, "1-URGENT"), (1, "1-URGENT"), (2, "5-LOW"), (3, "1-URGENT")], "o_orderkey long, o_orderpriority string")
    got = monthly_supplier_aggregate(lines, orders)
    assert got.columns == ["driver_id", "season", "round", "rev_cents", "qty", "n_lines", "n_ret", "n_open", "urgent_qty"]
    assert [got.schema[c].dataType.simpleString() for c in ("season", "round", "urgent_qty")] == ["int", "int", "bigint"]
    # null keys meet nothing in the join with the urgent quantity
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        (7, 1995, 12, 1101, 5, 2, 1, 1, 2), (7, 1996, 1, 200, 4, 1, 0, 0, 4), (7, None, None, 1000, 11, 2, 0, 0, 0), (None, 1996, 1, 250, 7, 1, 1, 1, 0)], key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_month" in plan and not any("Exchange" in line and "round#" in line for line in plan.splitlines())
