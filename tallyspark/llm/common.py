"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import ensure_checkpoint_dir

#: Rows up to which a key list (ids, pairs of ids) may be broadcast; beyond it the same join is shuffled.
BROADCAST_ROWS = 500_000


def work_path(spark: SparkSession, tag: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here
    and an executor that is lost later costs nothing."""
    path = work_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``limit`` rows (it stops counting there)."""
    return df.limit(limit + 1).count() <= limit


def hinted(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its checked size allows one."""
    return F.broadcast(df) if small(df, limit) else df


def hinted_bytes(df: DataFrame, size, limit: int) -> DataFrame:
    """``df`` with a broadcast hint if the sum of the column ``size`` allows one."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= limit else df


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file that all executors share."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a piece holds about ``limit`` bytes of
    ``column`` at most; a single longer value makes a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total, start = 0, 0
        for i, n in enumerate(size):
            if total and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        yield batch.slice(start)
        pa.default_memory_pool().release_unused()  # workers live on from one stage to the next


def range_bounds(df: DataFrame, key: str, shards: int, per_shard: int = 64) -> list:
    """``shards - 1`` split points of ``key``, the same on every run.

    They are quantiles of the rows whose key has the smallest hash, so they
    depend on the set of keys alone and not on partitions or task order. The
    sample is bounded by the number of shards.
    """
    if shards < 2:
        return []
    keys = df.select(F.col(key).alias("k")).where("k IS NOT NULL").distinct()
    got = sorted(r.k for r in keys.orderBy(F.xxhash64("k"), "k").limit(shards * per_shard).collect())
    return sorted({got[len(got) * i // shards] for i in range(1, shards)}) if got else []


def shard_of(key: str, bounds: list):
    """Shard number of ``key`` (nulls: 0) as a column: the number of bounds at
    or below it, looked up in two levels so that the cost grows with the root
    of the number of shards."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    fine = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    def upto(values, x):
        return F.size(F.filter(values, lambda b: b <= x))
    k = F.col(key)
    block = F.greatest(upto(F.lit([f[0] for f in fine]), k), F.lit(1))
    inside = upto(F.element_at(F.lit(fine) if len({len(f) for f in fine}) == 1 else F.array(*[F.lit(f) for f in fine]), block), k)
    return F.when(k.isNull(), 0).otherwise((block - 1) * step + inside).cast("int")


def blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()
