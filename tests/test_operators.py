"""Hand-computed edge cases (nulls, ties) and properties of the operators."""
import math

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import metrics as M
from tallyspark.operators.history import dense_rank_desc_within
from tallyspark.operators.ordered import position_within, prefix_sums
from tallyspark.functions.columns import is_dnf, le_or_zero


def test_auc_and_ap_with_ties(spark):
    # scores with a tie between a positive and a negative
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.3), (1, 0.2), (0, 0.1)]
    df = spark.createDataFrame([("a", y, s) for y, s in rows], "g string, y int, s double")
    r = M.auc_ap(df, ["g"], "y", "s").first()
    # pairs (pos, neg): 9; pos>neg: (0.9 > all 3) 3, (0.8 > 0.3, 0.1) 2 + tie .5, (0.2 > 0.1) 1 -> 6.5
    assert r["roc_auc"] == pytest.approx(6.5 / 9)
    # AP step-wise with tied scores as one step: thresholds .9 (p=1, r=1/3), .8 (p=2/3, r=2/3), .2 (p=3/5, r=1)
    assert r["average_precision"] == pytest.approx(1 / 3 * 1 + 1 / 3 * (2 / 3) + 1 / 3 * (3 / 5))


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([("a", 1, 0.3), ("a", 1, 0.5)], "g string, y int, s double")
    assert M.auc_ap(df, ["g"], "y", "s").first()["roc_auc"] is None


def test_spearman_average_ranks(spark):
    ys = [1.0, 2.0, 2.0, 3.0, 5.0]
    ps = [2.0, 1.0, 1.0, 4.0, 4.0]
    df = spark.createDataFrame([("a", y, p) for y, p in zip(ys, ps)], "g string, y double, p double")
    r = M.regression_metrics(df, ["g"], "y", "p").first()

    def ranks(v):
        s = sorted(v)
        return [(s.index(x) + 1 + s.index(x) + s.count(x)) / 2 for x in v]
    ry, rp = ranks(ys), ranks(ps)
    my, mp = sum(ry) / 5, sum(rp) / 5
    cov = sum((a - my) * (b - mp) for a, b in zip(ry, rp))
    rho = cov / math.sqrt(sum((a - my) ** 2 for a in ry) * sum((b - mp) ** 2 for b in rp))
    assert r["spearman"] == pytest.approx(rho)
    assert r["mae"] == pytest.approx(sum(abs(a - b) for a, b in zip(ys, ps)) / 5)


def test_ndcg_averages_tied_scores(spark):
    # 10 rows, relevance on rows 0 and 5; scores tie rows 4 and 5 at position 5/6
    scores = [10, 9, 8, 7, 6, 6, 4, 3, 2, 1]
    rel = [1, 0, 0, 0, 0, 1, 0, 0, 0, 0]
    df = spark.createDataFrame([("v", 1, 1, i, float(s), i + 1, r) for i, (s, r) in enumerate(zip(scores, rel))],
                               "split string, season int, round int, id int, score double, fin int, rel int")
    out = M.ranking_at_k(df, ["season", "round"], ["split"], "score", "fin", "rel", "id").first()
    d = lambda j: 1 / math.log2(j + 1)
    dcg = 1 * d(1) + 0.5 * (d(5) + d(6))
    idcg = d(1) + d(2)
    assert out["ndcg_at_10"] == pytest.approx(dcg / idcg)
    assert out["precision_at_10"] == 1.0


def test_best_threshold_lowest_wins_ties(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 0, 0.1)], "g string, y int, p double")
    r = M.best_f1_threshold(df, ["g"], "y", "p").first()
    assert r["best_f1"] == 1.0 and r["threshold"] == pytest.approx(0.11)


def test_dense_rank_keeps_nulls_null(spark):
    df = spark.createDataFrame([(1, 10), (1, None), (1, 10), (1, 5)], "e int, v int")
    out = sorted(((r["v"], r["rk"]) for r in dense_rank_desc_within(df, ["e"], "v", "rk").collect()),
                 key=lambda t: (t[0] is None, t[0] or 0))
    assert out == [(5, 2), (10, 1), (10, 1), (None, None)]


def test_position_within_equals_row_number(spark):
    from pyspark.sql import Window
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 1000).alias("v"),
                                     F.col("id"))
    a = position_within(df, ["g"], [("v", False), ("id", True)], "pos")
    b = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("v"), "id")))
    assert a.select("g", "id", "pos").exceptAll(b.select("g", "id", "pos")).count() == 0


def test_prefix_sums_with_hot_group(spark):
    # one group holds almost everything; the running sum must still be exact
    df = spark.range(0, 5000).select(F.when(F.col("id") < 4900, 0).otherwise(1).alias("g"),
                                     F.col("id").alias("o"), F.lit(1).alias("x"))
    out = prefix_sums(df, ["g"], [("o", True)], ["x"])
    bad = out.filter(F.when(F.col("g") == 0, F.col("o") + 1).otherwise(F.col("o") - 4899) != F.col("cum_x"))
    assert bad.count() == 0


def test_null_compares_as_zero_and_dnf(spark):
    df = spark.createDataFrame([(None, None, "Finished"), (2, 4, "+1 Lap"), (12, 3, "Engine"), (5, 5, None)],
                               "q int, fin int, status string")
    r = df.select(le_or_zero(F.col("q"), 10).alias("f"), is_dnf(F.col("fin"), F.col("status")).alias("d")).collect()
    assert [x["f"] for x in r] == [0, 1, 0, 1]
    assert [x["d"] for x in r] == [None, 0, 1, 1]


def test_pairwise_ranker_equals_brute_force_pairs(spark):
    """The moment-based normal equations equal the explicit all-pairs least
    squares solution (pairs enumerated here in numpy, on a small fixture)."""
    import numpy as np
    from tallyspark.operators.models import PairwiseRanker
    rng = np.random.default_rng(7)
    rows = []
    for ev in range(4):
        n = 6 + ev
        for i in range(n):
            rows.append((2000, ev, int(rng.integers(0, 4)), float(rng.normal()), float(rng.normal())))
    df = spark.createDataFrame(rows, "season int, round int, rel int, a double, b double")
    rk = PairwiseRanker(["a", "b"], l2=0.5).fit(df, "rel")
    X = np.array([[r[3], r[4]] for r in rows])
    A = np.zeros((2, 2))
    bvec = np.zeros(2)
    for i, ri in enumerate(rows):
        for j, rj in enumerate(rows):
            if ri[:2] == rj[:2] and ri[2] > rj[2]:
                dlt = X[i] - X[j]
                A += np.outer(dlt, dlt)
                bvec += dlt
    w = np.linalg.solve(A + 0.5 * np.eye(2), bvec)
    assert np.allclose(rk.weights, w)


def test_exact_quantiles_match_percentile(spark):
    from tallyspark.operators.quantiles import column_medians, exact_quantiles
    df = spark.range(0, 997).select((F.col("id") % 7).alias("g"), ((F.col("id") * 7919) % 1013 / 7.0).alias("v"),
                                    F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 13).alias("w"))
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75], ["a", "b", "c"]).collect()}
    want = df.groupBy("g").agg(F.percentile("v", [0.25, 0.5, 0.75]).alias("q")).collect()
    for r in want:
        assert [got[r["g"]][k] for k in "abc"] == pytest.approx(list(r["q"]))
    med = column_medians(df.withColumn("z", F.lit(None).cast("double")), ["v", "w", "z"]).first()
    ref = df.agg(F.percentile("v", 0.5).alias("v"), F.percentile("w", 0.5).alias("w")).first()
    assert med["v"] == pytest.approx(ref["v"]) and med["w"] == pytest.approx(ref["w"]) and med["z"] is None


def test_recent_rows_of_a_group_across_blocks(spark, monkeypatch):
    """Frames of the last rows that reach into the block before."""
    from tallyspark.operators import history as H
    from tallyspark.spec import DEFAULT_SPEC as S
    monkeypatch.setattr(H, "RECENT_BLOCK", 7)
    points = {(g, p): (p * p + g) % 11 for g in (1, 2) for p in range(1, 41)}
    first = 17
    x = spark.createDataFrame([(g * 100 + p, g, p, v, p >= first, p > first - 6) for (g, p), v in points.items()],
                              f"_row long, {S.group} int, _P long, _ep long, _live boolean, _context boolean")
    got = {r["_row"]: (r[1], r[2]) for r in H._compat_recent_rows(x, S).collect()}
    want = {g * 100 + p: tuple(sum(points[g, q] for q in range(p - n, p)) for n in (3, 5)) for g, p in points if p >= first}
    assert got == want


def test_supplier_listed_twice_keeps_one_order_in_all_ranks(spark):
    """Its two rows take adjacent positions, the same one first in each rank."""
    from tallyspark.sources.fixture import supplier_month_panel
    n = 12
    li = spark.createDataFrame([(i, i, 10.0 * (i % 5), float(i % 4), "N", "O", f"1995-0{1 + m}-03") for i in range(n) for m in range(2)],
                               "l_orderkey int, l_suppkey int, l_extendedprice double, l_quantity double, l_returnflag string, "
                               "l_linestatus string, l_shipdate string").withColumn("l_shipdate", F.to_date("l_shipdate"))
    orders = spark.createDataFrame([(i, "1-URGENT") for i in range(n)], "o_orderkey int, o_orderpriority string")
    sup = spark.createDataFrame([(i, f"s{i}", i % 3) for i in [*range(n), 4, 5]], "s_suppkey int, s_name string, s_nationkey int")
    got = {}
    for r in supplier_month_panel(li, orders, sup).collect():
        got.setdefault((r["season"], r["round"], r["driver_id"]), []).append((r["position_order"], r["grid"], r["quali_position"]))
    assert len(got) == 2 * n
    for (_, _, driver), rows in got.items():
        assert len(rows) == (2 if driver in (4, 5) else 1)
        if len(rows) == 2:
            a, b = sorted(rows)
            assert [y and y - x for x, y in zip(a, b) if x] == [1] * len([x for x in a if x])
