"""Embedding whitening against numpy's eigenvectors and exact integers."""
import math

import numpy as np
import pytest

from tallyspark.llm import catalog, op12_whitening as op12


def symmetric(rng, values):
    q, _ = np.linalg.qr(rng.normal(size=(len(values),) * 2))
    return (q * values) @ q.T


@pytest.mark.parametrize("d", [1, 2, 3, 7, 20])
def test_inertia_counts_and_solutions(d):
    rng = np.random.default_rng(d)
    for _ in range(20):
        a = rng.normal(size=(d, d)) * rng.choice([0, 1], size=(d, d), p=[0.4, 0.6])
        a = a + a.T - 2 * np.diag(np.diag(a)) * rng.integers(0, 2)
        e = np.linalg.eigvalsh(a)
        for s in rng.normal(size=5) * 2:
            f = op12.Shifted(a, s)
            assert f.above() == (e > s).sum()
            b = rng.normal(size=d)
            assert np.allclose((a - s * np.eye(d)) @ f.solve(b), b, atol=1e-6)


@pytest.mark.parametrize("values", [
    [9, 5, 4, 3, 2, 1], [4, 4, 4, 1, 0.5, 0.1], [1, 1 - 1e-9, 1 - 2e-9, 0.3, 0.2, 0.1], [1e12, 1, 1e-6, 0, 0, 0], [5, 0, 0, 0, 0, 0],
    list(np.linspace(1, 2, 40)), [3, 3], [7], [1e-200, 1e-201, 1e-202]])
def test_leading_components_equal_numpy(values):
    a = symmetric(np.random.default_rng(len(values)), np.array(values, float))
    a = (a + a.T) / 2
    norm = max(values)
    got = op12.leading(a, 4)
    positive = sorted((v for v in values if v > 1e-13 * norm), reverse=True)[:4]
    assert len(got) == len(positive)
    assert np.allclose([c.value for c in got], positive, rtol=1e-9, atol=1e-12 * norm)
    v = np.stack([c.vector for c in got], 1)
    assert np.allclose(v.T @ v, np.eye(len(got)), atol=1e-12)
    assert np.abs(a @ v - v * [c.value for c in got]).max() <= 1e-12 * norm
    for i, c in enumerate(got, 1):
        assert c.counted[0] >= i > c.counted[1]


def test_rayleigh_quotient_iteration_converges_fast():
    a = symmetric(np.random.default_rng(3), np.linspace(1, 10, 60) ** 2)
    for c in op12.leading((a + a.T) / 2, 4):
        assert len(c.residuals) <= 4


def test_no_component_of_nothing():
    assert op12.leading(np.zeros((0, 0))) == [] and op12.leading(np.zeros((3, 3))) == []


def test_products_are_exact_for_all_sizes():
    rng = np.random.default_rng(1)
    for most in (3, 1 << 20, 1 << 26, 1 << 40, (1 << 62) + 5):
        x = rng.integers(-most, most, size=(50, 3))
        big = x.astype(object)
        assert (op12.exact_sum(x) == big.sum(0)).all() and (op12.exact_gram(x) == big.T @ big).all()
        c = np.array([5, -most, most], object)
        assert (op12.centred(x, c).astype(object) == big - c).all()


def plain(rows, k=4, scale=256):
    """{row number: [(component, n, deviation, |whitened|, explained)]} with numpy."""
    x = {}
    dims = max((len(v) for _, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)), default=0)
    for r, (_, v) in enumerate(rows):
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            x[r] = tuple(math.floor(scale * c) for c in v) + (0,) * (dims - len(v))
    fit = sorted(set(x.values()))
    if not fit or not dims:
        return {}
    n, big = len(fit), np.array(fit, object)
    total = big.sum(0)
    y = ((big * n - total) / n).astype(float)
    cov = y.T @ y / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    keep = [i for i in range(min(k, dims)) if e[i] > 1e-12 * e[0]]
    out = {}
    for r, v in x.items():
        away = [n * a - int(s) for a, s in zip(v, total, strict=True)]
        w = (np.array([a / n for a in away]) @ q[:, keep]) / np.sqrt(e[keep])
        out[r] = [(i + 1, n, sum(a * a for a in away), abs(w[i]), e[i] / e.sum()) for i in keep]
    return out


def check(spark, rows, schema="vec_id long, embedding array<float>"):
    df = spark.createDataFrame([(i, v) for i, (_, v) in enumerate(rows)], schema).repartition(3)
    got = {}
    for r in op12.whiten(df).collect():
        got.setdefault(r.vec_id, []).append(r)
        assert r.identity_error <= 1e-9
    want = plain(rows)
    assert set(got) == {i for i, w in want.items() if w}
    for i, rs in got.items():
        rs.sort(key=lambda r: r.component)
        assert [(r.component, r.n, r.deviation) for r in rs] == [w[:3] for w in want[i]]
        assert np.allclose([abs(r.whitened) for r in rs], [w[3] for w in want[i]], atol=1e-7)
        assert np.allclose([r.explained for r in rs], [w[4] for w in want[i]], rtol=1e-9)
    return got


def test_query_equals_plain_version(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = plain(rows)
    got = {}
    for r in catalog.QUERIES["op12_whitened_embeddings"](spark, sf_dir).collect():
        got.setdefault(r.vec_id, []).append(r)
    assert set(got) == {i for i, _ in rows}
    for number, (i, _) in enumerate(rows):
        for r, w in zip(sorted(got[i], key=lambda r: r.component), want[number], strict=True):
            assert (r.component, r.n, r.deviation) == w[:3]
            assert abs(r.whitened) == pytest.approx(w[3], abs=1e-9) and r.explained == pytest.approx(w[4], rel=1e-10)
            assert r.identity_error <= 1e-9


def test_signs_are_the_same_for_all_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 5)) * [5, 3, 2, 1, 0.5]
    got = op12.whiten(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(5)).collect()
    y = np.floor(x.astype(np.float32).astype(float) * 256)
    y = y - y.mean(0)
    _, q = np.linalg.eigh(y.T @ y)
    for c in (1, 2, 3, 4):
        w = np.array([r.whitened for r in sorted(got, key=lambda r: r.vec_id) if r.component == c])
        assert abs(np.corrcoef(w, y @ q[:, -c])[0, 1]) > 1 - 1e-9


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(0, rng.normal(size=6).tolist()) for _ in range(40)]
    rows += [(0, None), (0, [1.0, None]), (0, [float("nan")]), (0, [float("inf"), 0.0]), (0, []), (0, [0.5, -0.25]), (0, [-0.0] * 6), rows[0], rows[0]]
    check(spark, rows)


@pytest.mark.parametrize("rows", [
    [], [None], [[]], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [[1.0, 2.0], [2.0, 4.0], [4.0, 8.0]], [[1.0], [2.0]], [[1.0, 0.0, 0.0], [-1.0, 0.0, 0.0]]])
def test_few_rows_and_low_rank(spark, rows):
    check(spark, [(0, v) for v in rows])


def test_a_hot_vector_counts_once(spark):
    rng = np.random.default_rng(6)
    check(spark, [(0, v.tolist()) for v in rng.normal(size=(30, 4))] + [(0, [9.0, 9.0, 9.0, 9.0])] * 300)


def test_large_entries_are_exact_and_too_large_ones_raise(spark):
    big = [(0, [7e4, -3e5, 1.0]), (0, [9e4, 2e5, 0.0]), (0, [1e5, 0.0, 2.0]), (0, [-2e5, 1e5, 5.0]), (0, [1e3, 1e5, -5.0])]
    check(spark, big, "vec_id long, embedding array<double>")
    for size in (1e17, 1e12):  # an entry, and a deviation, beyond a long
        df = spark.createDataFrame([(1, [size]), (2, [0.0])], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="range of a long"):
            op12.whiten(df).collect()


def test_null_ids_repeats_and_clashing_columns(spark):
    rows = [(None, [1.0, 2.0], 1, 2, 3), (None, [0.0, 2.0], 1, 2, 3), (5, [3.0, 1.0], 1, 2, 3), (5, [3.0, 1.0], 1, 2, 3)]
    got = op12.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>, x int, n int, component int")).collect()
    assert sorted((r.vec_id is None, r.component) for r in got) == [(False, 1)] * 2 + [(False, 2)] * 2 + [(True, 1)] * 2 + [(True, 2)] * 2
    assert {r.n for r in got} == {3}
