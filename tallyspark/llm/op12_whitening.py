"""Embedding whitening: leading principal components by spectrum slicing.

Vectors become rows of integers (floor of scale times the entry). The fit list
holds each distinct row once; its sums and, after centring, its products are
integers that every task adds up exactly and Spark sums as decimals, so the
covariance is the same on every run and rounded once.

The covariance (dims x dims, the only thing besides the sums that reaches the
driver) is sliced: an LDL' factorisation of V - s I with symmetric pivoting has
as many positive pivots as V has eigenvalues above s (Sylvester's inertia).
Counts and bisection isolate the i-th largest eigenvalue, Rayleigh quotient
iteration refines it with the same factorisation, and two more counts, just
below and just above the result, certify that it is number i.

Defined cases: rows whose vector is null or has a null or non-finite entry are
dropped; entries missing from a shorter vector count as 0; an empty vector is
all zeros; repeated vectors are fitted once and returned for each row; null and
repeated ids are returned as they are; components without variance (beyond the
rank, so all of them with one distinct row) can't be whitened and have no rows;
equal eigenvalues get orthonormal vectors; entries whose integer leaves the
range of a long, and deviations that do, raise an error; an empty table gives
an empty result. Columns besides the id and the vector are not read.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SCALE = 256
COMPONENTS = 4
EPS = np.finfo(float).eps
RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


# ------------------------------------------------------------------ integers
def integer_rows(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and x (array of long, all of the same length) of the rows that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    usable = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    def whole(c):
        y = F.floor(c * scale)
        return F.when(F.abs(c * scale) < 2.0 ** 63, y).otherwise(F.raise_error(F.lit("a vector's entry leaves the range of a long")).cast("long"))
    x = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.when(usable, F.transform(v, whole)).alias("x")).where("x IS NOT NULL")
    dims = x.agg(F.max(F.size("x"))).first()[0] or 0
    return x.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x"))))


def matrix(column: pa.Array) -> np.ndarray:
    """Arrow lists of one length as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def largest(a: np.ndarray) -> int:
    return max(int(a.max()), -int(a.min())) if a.size else 0


def exact_sum(x: np.ndarray) -> np.ndarray:
    """Column sums as Python integers."""
    wide = largest(x) * len(x) >= 1 << 62
    return (x.astype(object) if wide else x).sum(0).astype(object)


def exact_gram(y: np.ndarray) -> np.ndarray:
    """Sum of y y' over the rows as Python integers. Products of doubles are
    exact up to 2 ** 53, so rows go through the fast product in blocks that
    can't pass it; larger values are multiplied as integers."""
    most = largest(y)
    total = np.zeros((y.shape[1],) * 2, object)
    if most > 1 << 24:
        return y.astype(object).T @ y.astype(object)
    rows = max(1, (1 << 53) // max(1, most * most))
    for at in range(0, len(y), rows):
        part = y[at:at + rows].astype(float)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def centred(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """x - centre, in integers."""
    if largest(x) + largest(centre) >= 1 << 62:
        return x.astype(object) - centre
    return x - centre.astype(np.int64)


@dataclass
class Moments:
    """Of the fit list: rows, sums, the integer centre next to the mean, and the covariance."""
    n: int
    sums: list[int]
    centre: list[int]
    covariance: np.ndarray

    @property
    def rest(self) -> list[int]:
        """Sums of the centred rows."""
        return [s - self.n * c for s, c in zip(self.sums, self.centre, strict=True)]


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def moments(fit: DataFrame) -> Moments:
    """Moments of the rows ``x`` of ``fit``, which is read twice."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for b in batches:
            if b.num_rows:
                n += b.num_rows
                part = exact_sum(matrix(b.column(0)))
                total = part if total is None else total + part
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([-1, *range(len(total))], pa.int32()), _decimals([n, *total])], ["i", "s"])

    got = {r.i: int(r.s) for r in fit.select("x").mapInArrow(sums, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    n = got.pop(-1, 0)
    total = [got[i] for i in range(len(got))]
    centre = [(2 * s + n) // (2 * n) for s in total] if n else []
    at = np.array(centre, object)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = None
        for b in batches:
            if b.num_rows:
                part = exact_gram(centred(matrix(b.column(0)), at))
                gram = part if gram is None else gram + part
        if gram is not None:
            i, j = np.triu_indices(len(gram))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), _decimals(gram[i, j])], ["i", "j", "s"])

    out = Moments(n, total, centre, np.zeros((len(total),) * 2))
    if total:
        rest = out.rest
        summed = fit.select("x").mapInArrow(products, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s"))
        for r in summed.toLocalIterator():
            # integers up to the one division, which Python rounds correctly
            value = (n * int(r.s) - rest[r.i] * rest[r.j]) / (n * n)
            out.covariance[r.i, r.j] = out.covariance[r.j, r.i] = value
    return out


# ------------------------------------------------------------------ spectrum
class Shifted:
    """LDL' of the symmetric matrix a - shift I with pivots of order 1 and 2
    (Bunch and Kaufman)."""

    def __init__(self, a: np.ndarray, shift: float):
        d = len(a)
        m = a - shift * np.eye(d)
        self.tiny = EPS * max(np.abs(m).max(initial=0.0), np.finfo(float).tiny / EPS)
        self.order, self.blocks, self.low = np.arange(d), [], np.eye(d)
        alpha, k = (1 + 17 ** 0.5) / 8, 0
        while k < d:
            size = 1
            below = np.abs(m[k + 1:, k])
            if below.size and below.max() > 0:
                r = k + 1 + int(below.argmax())
                most = below.max()
                if abs(m[k, k]) < alpha * most:
                    other = np.abs(m[r, k:]).copy()
                    other[r - k] = 0
                    if abs(m[k, k]) * other.max() >= alpha * most * most:
                        pass
                    elif abs(m[r, r]) >= alpha * other.max():
                        self._swap(m, k, r)
                    else:
                        size = 2
                        self._swap(m, k + 1, r)
            block = m[k:k + size, k:k + size].copy()
            if size == 1 and abs(block[0, 0]) < self.tiny:
                block[0, 0] = np.copysign(self.tiny, block[0, 0])
            left = m[k + size:, k:k + size]
            factor = left @ np.linalg.inv(block)
            m[k + size:, k + size:] -= factor @ left.T
            self.low[k + size:, k:k + size] = factor
            self.blocks.append((k, block))
            k += size

    def _swap(self, m: np.ndarray, i: int, j: int) -> None:
        if i != j:
            m[[i, j]] = m[[j, i]]
            m[:, [i, j]] = m[:, [j, i]]
            self.order[[i, j]] = self.order[[j, i]]
            first = min(i, j)
            self.low[[i, j], :first] = self.low[[j, i], :first]

    def above(self) -> int:
        """Eigenvalues above the shift: positive pivots (a block of order 2 has one or counts both by its trace)."""
        count = 0
        for _, b in self.blocks:
            if len(b) == 1:
                count += b[0, 0] > 0
            else:
                det = b[0, 0] * b[1, 1] - b[0, 1] * b[1, 0]
                count += 1 if det < 0 else 2 * (b[0, 0] + b[1, 1] > 0)
        return int(count)

    def solve(self, v: np.ndarray) -> np.ndarray:
        y = v[self.order].astype(float)
        for k in range(len(y)):
            y[k + 1:] -= self.low[k + 1:, k] * y[k]
        for k, b in self.blocks:
            y[k:k + len(b)] = np.linalg.solve(b, y[k:k + len(b)])
        for k in range(len(y) - 1, -1, -1):
            y[k] -= self.low[k + 1:, k] @ y[k + 1:]
        out = np.empty_like(y)
        out[self.order] = y
        return out


@dataclass
class Component:
    value: float
    vector: np.ndarray
    residuals: list[float]
    counted: tuple[int, int]


def _orthogonal(v: np.ndarray, found: list[Component]) -> np.ndarray:
    for _ in range(2):
        for c in found:
            v = v - (c.vector @ v) * c.vector
    return v


def leading(a: np.ndarray, k: int = COMPONENTS) -> list[Component]:
    """The k largest eigenvalues of the positive semidefinite matrix ``a``, as
    far as they are positive, with unit vectors, certified by counts."""
    d = len(a)
    scale = float(np.abs(a).sum(0).max(initial=0.0))
    if not scale:
        return []
    a = a / scale  # eigenvalues in 0 to 1
    tol = 4 * EPS * d
    found: list[Component] = []
    counts: dict[float, int] = {1 + tol: 0}

    def above(s: float) -> int:
        if s not in counts:
            counts[s] = Shifted(a, s).above()
        return counts[s]

    for i in range(1, min(k, above(tol)) + 1):
        # the tightest shifts that earlier counts already gave
        lo = max((s for s, n in counts.items() if n >= i), default=tol)
        hi = min(s for s, n in counts.items() if n < i)
        start = np.cos(np.arange(1, d + 1) * (i + 0.5))
        while True:
            while hi - lo > tol and not (above(lo) == i and above(hi) == i - 1):
                mid = (lo + hi) / 2
                lo, hi = (mid, hi) if above(mid) >= i else (lo, mid)
            # eigenvalues that can't be told apart share a space: stay orthogonal to what was found
            slack = tol if hi - lo <= tol else 0.0
            shift, v, residuals = (lo + hi) / 2, _orthogonal(start, found), []
            v /= np.linalg.norm(v)
            step = Shifted(a, shift)
            for _ in range(2):
                v = _orthogonal(step.solve(v), found)
                v /= np.linalg.norm(v)
            for _ in range(12):
                value = float(v @ a @ v)
                residuals.append(float(np.linalg.norm(a @ v - value * v)))
                if residuals[-1] <= tol / 8 or len(residuals) > 3 and residuals[-1] >= residuals[-2] and residuals[-1] <= tol:
                    break
                if not lo - slack < value <= hi + slack:
                    break
                v = _orthogonal(Shifted(a, value).solve(v), found)
                v /= np.linalg.norm(v)
            if lo - slack < value <= hi + slack and residuals[-1] <= tol:
                break
            if hi - lo <= tol:
                raise ArithmeticError(f"component {i} did not converge")
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if above(mid) >= i else (lo, mid)
        found.append(Component(value, v, residuals, (above(value - 2 * tol), above(value + 2 * tol))))
        if not (found[-1].counted[0] >= i > found[-1].counted[1]):
            raise ArithmeticError(f"component {i}: counts {found[-1].counted} contradict its number")
    found.sort(key=lambda c: -c.value)
    return [Component(c.value * scale, c.vector, c.residuals, c.counted) for c in found]


# ---------------------------------------------------------------- whitening
def whiten(df: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """A row for each row of ``df`` that takes part and each component:
    ``RESULT``. Sends 8 (k + 2) bytes a dimension to the tasks."""
    spark = df.sparkSession
    rows = integer_rows(df, id_col, vector_col, scale)
    fit = common.store(rows.select("x").distinct(), "whitening-fit")
    m = moments(fit)
    parts = leading(m.covariance, k)
    if not parts:
        return spark.createDataFrame([], RESULT)
    n, k = m.n, len(parts)
    centre, rest = np.array(m.centre, object), np.array(m.rest, object)
    offset = np.array([r / n for r in m.rest])
    basis = np.stack([c.vector / c.value ** 0.5 for c in parts], 1)
    explained = np.array([c.value for c in parts]) / np.trace(m.covariance)

    def projected(x: np.ndarray) -> np.ndarray:
        return (centred(x, centre).astype(float) - offset) @ basis

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for b in batches:
            if b.num_rows:
                w = projected(matrix(b.column(0)))
                total += np.concatenate([w.T @ w, w.sum(0)[None]])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "s"])

    total = np.zeros((k + 1, k))
    for r in fit.mapInArrow(products, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        total[r.i, r.j] = r.s
    mean = total[k] / n
    error = float(np.abs(total[:k] / n - np.outer(mean, mean) - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column("x"))
            y = centred(x, centre)
            wide = (largest(y) + 1) ** 2 * n * n * x.shape[1] >= 1 << 62
            away = (y.astype(object) * n - rest) if wide else (y * n - rest.astype(np.int64))
            deviation = (away * away).sum(1)
            if wide and max(deviation) >= 1 << 63:
                raise OverflowError("a deviation leaves the range of a long")
            w = projected(x)
            ids = b.column("vec_id")
            every = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(every)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(every), n, np.int64)),
                pa.array([int(v) for v in np.repeat(deviation, k)] if wide else np.repeat(deviation, k), pa.int64()), pa.array(w.ravel()),
                pa.array(np.tile(explained, len(x))), pa.array(np.full(len(every), error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, RESULT)
