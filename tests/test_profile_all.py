"""Masked Gram moments against pair-by-pair numpy."""
import numpy as np
import pytest

from tallyspark.operators import profile as PR


def test_pair_moments_and_correlations(spark):
    rng = np.random.default_rng(3)
    n = 300
    x = rng.normal(size=(n, 5)) * [1, 1e4, 1e-4, 1, 1] + [0, 1e6, 0, 7, 0]
    x[:, 3] = 7.0                                  # constant
    x[:, 4] = np.where(np.arange(n) < 5, 2.5, np.nan)  # constant where known
    x[:, 0] += x[:, 1] / 1e4
    x[rng.random((n, 5)) < 0.2] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    cols = ["a", "b b", "c", "k", "few", "none"]
    df = spark.createDataFrame([(*r, None) for r in rows], "a double, `b b` double, c double, k double, few double, none double").repartition(4)
    got = {(r.col_a, r.col_b): r for r in PR.correlation_table(df, cols).collect()}
    moments = {(r.col_a, r.col_b): r for r in PR.pair_moments(df, cols).collect()}
    assert len(got) == 21
    full = np.concatenate([x, np.full((n, 1), np.nan)], 1)
    for i, a in enumerate(cols):
        for j, b in enumerate(cols[i:], i):
            both = ~np.isnan(full[:, i]) & ~np.isnan(full[:, j])
            u, v = full[both, i], full[both, j]
            r, m = got[a, b], moments[a, b]
            assert r.n == both.sum() and m.p == pytest.approx(((u - m.mean_a) * (v - m.mean_b)).sum(), rel=1e-9, abs=1e-9)
            if len(u) < 2 or u.std() == 0 or v.std() == 0:
                assert r["corr"] is None, (a, b)
            else:
                assert r["corr"] == pytest.approx(np.corrcoef(u, v)[0, 1], abs=1e-9)


def test_empty_table(spark):
    got = PR.correlation_table(spark.createDataFrame([], "a double, b double"), ["a", "b"]).collect()
    assert all(r.n == 0 and r["corr"] is None for r in got)


def test_the_oracle_covers_all_model_features(spark, sf_dir):
    from tallyspark.plans import catalog_panel as P
    assert P._model_features(spark, sf_dir)[1] == P.FEATURES


def test_feature_presence_of_many_columns(spark):
    """Null rates and deviations against numpy; no aggregate grows with the number of columns."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 40)) * 5 + 100
    x[rng.random((200, 40)) < 0.3] = np.nan
    x[:, 7], x[1:, 8] = np.nan, np.nan
    x[0, 8] = 3.0
    cols = [f"c{i}" for i in range(40)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{c} double" for c in cols)).repartition(3)
    out = PR.feature_presence(df, cols)
    assert str(out._jdf.queryExecution().optimizedPlan()).count("stddev_samp") <= 2
    got = {r.feature: r for r in out.collect()}
    assert list(sorted(got)) == sorted(cols)
    for i, c in enumerate(cols):
        known = x[~np.isnan(x[:, i]), i]
        assert got[c].null_rate == pytest.approx(1 - len(known) / 200)
        assert got[c].std == (pytest.approx(known.std(ddof=1), rel=1e-9) if len(known) > 1 else None)
    empty = PR.feature_presence(df.where("c0 > 1e9"), cols).collect()
    assert len(empty) == 40 and all(r.null_rate is None and r.std is None for r in empty)
