"""What models may see and what a top-N table promises, by perturbation and by hand."""
from pyspark.sql import functions as F

from tallyspark.functions.columns import prepare_panel
from tallyspark.operators import quality as Q
from tallyspark.operators.history import add_history_features
from tallyspark.operators.rank import predict_top_n
from tallyspark.operators.split import numeric_feature_columns
from tallyspark.plans.panel import base_panel
from tallyspark.spec import DEFAULT_SPEC as S

TOP = "season int, round int, driver_id string, race_rank_score double, expected_points double, proba_podium double, proba_top10 double, mode string"


def test_a_mode_sees_the_starting_order_only_after_qualifying(spark, sf_dir):
    """Change one event's starting order, or its outcomes: that event's
    features of the early mode stay, those of the late mode see the start."""
    base, e = base_panel(spark, sf_dir), 20
    here = F.col("event_seq") == e

    def changed(**cols):
        other = base.withColumns({c: F.when(here, v).otherwise(F.col(c)) for c, v in cols.items()})
        panels = [add_history_features(prepare_panel(x, S), S).filter(here) for x in (base, other)]
        return {m: not panels[0].select(*KEY, *names[m]).exceptAll(panels[1].select(*KEY, *names[m])).isEmpty() for m in names}

    KEY = ["driver_id"]
    full = add_history_features(prepare_panel(base, S), S)
    names = {m: numeric_feature_columns(full, m) for m in ("pre_quali", "post_quali")}
    assert changed(grid=F.lit(4), quali_position=F.col("quali_position") + 1) == {"pre_quali": False, "post_quali": True}
    assert changed(position_order=F.lit(3), points=F.lit(1), status=F.lit("Retired")) == {"pre_quali": False, "post_quali": False}


def test_top_n_rows_by_hand(spark):
    rows = [
        # d is listed twice and keeps its better row; a and b tie on the score, points decide; c has no score
        (2001, 1, "a", 5.0, 2.0, 0.5, 0.9, "PRE"), (2001, 1, "b", 5.0, 3.0, 0.1, 0.2, "PRE"), (2001, 1, "c", None, 99.0, 1.0, 1.0, "PRE"),
        (2001, 1, "d", 1.0, 50.0, 0.9, 0.9, "PRE"), (2001, 1, "d", 7.0, 0.0, 0.0, 0.0, "PRE"), (2001, 1, "e", 4.0, 9.0, 0.9, 0.9, "PRE"),
        # fewer entrants than ranks; x and y are equal in everything but the id
        (2001, 2, "y", 2.0, 1.0, 0.3, 0.3, "POST"), (2001, 2, "x", 2.0, 1.0, 0.3, 0.3, "POST"), (2001, 2, "z", None, None, None, None, "POST"),
    ]
    got = predict_top_n(spark.createDataFrame(rows, TOP).repartition(4), ["season", "round"], "driver_id", 4)
    assert sorted((r.round, r.predicted_rank, r.driver_id, r.expected_points) for r in got.collect()) == [
        (1, 1, "d", 0.0), (1, 2, "b", 3.0), (1, 3, "a", 2.0), (1, 4, "e", 9.0), (2, 1, "x", 1.0), (2, 2, "y", 1.0), (2, 3, "z", None)]


def test_each_broken_promise_is_reported(spark):
    """A table per defect; only its own check fails."""
    good = [(2001, i, 1, "a", 5.0, 2.0, 0.5, 0.9, "PRE") for i in range(6)] + [(2001, i, 2, "b", 4.0, 1.0, 0.0, 1.0, "POST") for i in range(6)]
    defects = {1: (8, "LATER"), 2: (7, 1.5), 3: (5, -0.1), 4: (4, 6.0), 5: (3, "a")}
    rows = [tuple(defects[r[1]][1] if r[2] == 2 and r[1] in defects and k == defects[r[1]][0] else v for k, v in enumerate(r)) for r in good]
    df = spark.createDataFrame(rows, "season int, round int, predicted_rank int, driver_id string, race_rank_score double, expected_points double, "
                                     "proba_podium double, proba_top10 double, mode string")
    got = Q.contract_checks(df, 2, "driver_id", ["proba_podium", "proba_top10"], ["expected_points"], "race_rank_score", "predicted_rank", "mode",
                            ["PRE", "POST"], by=["round"])
    failed = {r.round: [c for c in r.asDict() if c.endswith("_ok") and not r[c]] for r in got.collect()}
    assert failed == {0: [], 1: ["mode_ok"], 2: ["probabilities_ok"], 3: ["non_negative_ok"], 4: ["order_ok"], 5: ["unique_ok"]}


def test_leakage_perturbation(spark):
    """Change every outcome of one event: strict features of all rows up to
    and including that event must not change (nothing of the current event
    is visible)."""
    sf = "/root/testdata/sf0.01"
    base = base_panel(spark, sf)
    e = 30
    pert = base.withColumns({
        "position_order": F.when(F.col("event_seq") == e, 1000 - F.col("position_order")).otherwise(F.col("position_order")),
        "points": F.when(F.col("event_seq") == e, F.lit(7)).otherwise(F.col("points")),
        "status": F.when(F.col("event_seq") == e, F.lit("Retired")).otherwise(F.col("status")),
    })
    a = add_history_features(prepare_panel(base, S), S)
    b = add_history_features(prepare_panel(pert, S), S)
    outcome_like = {"position_order", "points", "status", "grand_prix_points", "event_points", "target_top10",
                    "target_podium", "target_points", "is_dnf", "grid_to_finish_delta"}
    feats = [c for c in a.columns if c not in outcome_like]
    a2 = a.filter(F.col("event_seq") <= e).select(*feats)
    b2 = b.filter(F.col("event_seq") <= e).select(*feats)
    assert a2.exceptAll(b2).count() == 0
    # and the next event does see the change
    a3 = a.filter(F.col("event_seq") == e + 1).select(*feats)
    b3 = b.filter(F.col("event_seq") == e + 1).select(*feats)
    assert a3.exceptAll(b3).count() > 0
