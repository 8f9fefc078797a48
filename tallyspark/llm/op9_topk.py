"""Exact top-k search by inner product over an impact-ordered index.

Vectors are rows of integers (floor of scale times the component). Each block
of candidates is a shard with its own index: for every dimension and sign, the
postings (vector, impact above the shard's least value) in segments of
descending quantised impact. A query processes segments score at a time, from
the highest bound of contribution down, adding exact impacts to accumulators.
What is left is bounded by the sum over dimensions of weight times the next
segment's bound. The vectors ahead are scored exactly now and then, and it
stops only when every vector outside a short list of possible members is
proven to lie below the k-th best of those; the possible members are scored
exactly. Shards' lists meet in a window over
(query, shard) lists of k rows.

Queries go to all shards in blocks of bounded size (a broadcast of
``QUERY_BLOCK`` vectors each), candidates are never broadcast.

Defined cases: vectors that are null, or hold a null or a non-finite
component, take no part; a missing component of a shorter vector counts as 0;
a component beyond +-2**27 after scaling raises an error, as products of such
could leave the range of a long; a row whose id equals the
query's id is the query's own and no candidate; null ids are candidates but no
queries, and come first among equal scores; repeated candidate rows are listed
each. Empty tables give an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

SCALE = 256
LIMIT = 1 << 27
QUERY_BLOCK = 2048
SHARD_ROWS = 16384
LEVELS = 4
#: Vectors ahead that are scored exactly to bound the k-th best, and the share of a shard that may be left to exact scoring (one product).
AHEAD, POSSIBLE = 64, 1 / 2
#: Times that a query looks whether it can stop.
CHECKS = 8
SCORED = "query_id long, vec_id long, score long"


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``id`` and ``v`` (array of long) of the rows that take part."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    beyond = F.raise_error(F.lit(f"a component is beyond +-{LIMIT} after scaling by {scale}")).cast("long")
    held = F.transform(x, lambda c: F.when(F.abs(c * scale) <= LIMIT, F.floor(c * scale)).otherwise(beyond))
    return df.select(F.col(id_col).cast("long").alias("id"), F.when(finite, held).alias("v")).where("v IS NOT NULL")


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of integers, short rows filled up with 0."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.diff(column.offsets.to_numpy())
    if len(size) and (size == dims).all():
        return values.reshape(-1, dims)
    out = np.zeros((len(size), dims), np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    for i, n in enumerate(size):
        out[i, :n] = values[at[i]:at[i + 1]]
    return out


class ImpactIndex:
    """Segments of descending quantised impact, per dimension and sign."""

    def __init__(self, vectors: np.ndarray, levels: int = LEVELS):
        self.v = vectors
        self.low, self.high = vectors.min(0), vectors.max(0)
        n, dims = vectors.shape
        cuts = np.unique(np.linspace(0, n, min(levels, n) + 1).astype(int))
        self.cuts = cuts
        up = np.argsort(-vectors, axis=0, kind="stable")
        self.order = {1: np.ascontiguousarray(up.T), -1: np.ascontiguousarray(up[::-1].T)}
        ordered = np.take_along_axis(vectors, up, 0).T
        self.impact = {1: ordered - self.low[:, None], -1: self.high[:, None] - ordered[:, ::-1]}
        # bound of each segment: its first, highest impact; after the last nothing is left
        self.bound = {s: np.concatenate([i[:, cuts[:-1]].astype(np.int64), np.zeros((dims, 1), np.int64)], 1) for s, i in self.impact.items()}

    def search(self, q: np.ndarray, k: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that may be among the k best and their exact scores; ``own``
        marks the rows that are no candidates."""
        n = len(self.v)
        if n - own.sum() <= max(k, AHEAD):
            rows = np.flatnonzero(~own)
            return rows, self.v[rows] @ q
        dims = np.flatnonzero(q)
        sign = np.where(q[dims] > 0, 1, -1)
        weight = np.abs(q[dims])
        segments = len(self.cuts) - 1
        gain = np.stack([self.bound[s][d] for d, s in zip(dims, sign, strict=True)]) * weight[:, None] if len(dims) else np.zeros((0, segments + 1), np.int64)
        turn = np.argsort(-gain[:, :segments], axis=None, kind="stable")
        acc = np.zeros(n, np.int64)
        acc[own] = -1 << 62
        left = int(gain[:, 0].sum())
        base = int((q[dims] * np.where(sign > 0, self.low[dims], self.high[dims])).sum())
        every, rows = max(1, len(turn) // CHECKS), np.arange(n)
        for done, t in enumerate(turn, 1):
            j, s = divmod(int(t), segments)
            d, sg = dims[j], int(sign[j])
            part = slice(self.cuts[s], self.cuts[s + 1])
            acc[self.order[sg][d, part]] += weight[j] * self.impact[sg][d, part]
            left -= int(gain[j, s] - gain[j, s + 1])
            if done % every == 0:
                # the k-th best of some exact scores bounds the k-th best of all from below
                ahead = np.argpartition(acc, n - AHEAD)[n - AHEAD:]
                ahead = ahead[acc[ahead] >= 0]
                if len(ahead) >= k:
                    theta = np.partition(self.v[ahead] @ q - base, len(ahead) - k)[len(ahead) - k]
                    rows = np.flatnonzero(acc + left >= theta)
                    if len(rows) <= n * POSSIBLE:
                        break
        rows = rows[~own[rows]]
        return rows, self.v[rows] @ q


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, query_block: int = QUERY_BLOCK,
          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The k rows of ``vectors`` (id, v) with the highest inner product for
    each row of ``queries``: query_id, rank, vec_id, score."""
    vectors, queries = common.store(vectors, "topk-vectors"), common.store(queries.where("id IS NOT NULL"), "topk-queries")
    total = vectors.count()
    dims = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    blocks = max(1, -(-queries.count() // query_block))
    dealt = vectors.repartition(max(1, -(-total // shard_rows)), F.xxhash64("id", "v"))
    found = None
    for b in range(blocks):  # a stated query set against all rows, in blocks of a bounded size
        own = [(r.id, r.v) for r in queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()]
        sent = vectors.sparkSession.sparkContext.broadcast(own)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, parts, held = [], [], 0

            def flush() -> pa.RecordBatch:
                index, known, out = ImpactIndex(np.concatenate(parts)), np.array(ids, object), []
                key = np.array([i is not None for i in ids])
                number = np.array([i or 0 for i in ids], np.int64)
                for qid, v in sent.value:
                    q = np.zeros(dims, np.int64)
                    q[:len(v)] = v
                    rows, score = index.search(q, k, key & (number == qid))
                    best = np.lexsort((number[rows], key[rows], -score))[:k]
                    out += [(qid, known[rows[i]], int(score[i])) for i in best]
                columns = list(zip(*out, strict=True)) or [[], [], []]
                return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

            for batch in batches:
                for at in range(0, batch.num_rows, shard_rows):
                    piece = batch.slice(at, shard_rows)
                    if held and held + piece.num_rows > 2 * shard_rows:
                        yield flush()
                        ids, parts, held = [], [], 0
                    ids += piece.column("id").to_pylist()
                    parts.append(matrix(piece.column("v"), dims))
                    held += piece.num_rows
            if held and dims:
                yield flush()

        part = dealt.mapInArrow(search, SCORED)
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_first())
    # rank within (query, salt) first, so that no task holds one query's lists of all shards
    salted = Window.partitionBy("query_id", "salt").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_first())
    found = common.store(found, "topk-found")
    first = found.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(16))).withColumn("r", F.row_number().over(salted)).where(F.col("r") <= k)
    return first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
