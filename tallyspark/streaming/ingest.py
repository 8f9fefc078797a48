"""Incremental snapshot ingest with Structured Streaming.

New page files under ``incoming`` are read with ``readStream`` (explicit
schema) and flattened (S7); ``foreachBatch`` appends the rows of each epoch to
a log of its own folder (``epoch=7``), with the page file's modification time
and the page's offset. A retried epoch overwrites its folder only, so nothing
earlier can be lost, and no batch reads or rewrites what is there already.
Reading the table keeps the latest row of each result key: one aggregate,
partial per task, ordered by (epoch, file time, page offset).
``trigger(availableNow=True)`` processes what has arrived and stops; the
streaming checkpoint makes re-runs pick up only new files.

``compact`` folds the finished epochs into a snapshot, so that a read costs the
snapshot and the few epochs since, however many there were:

1. the latest rows of the seasons that the new epochs touch are written to a
   new folder (other seasons stay where they are);
2. the one small file ``_manifest`` is replaced: it names every season's folder
   and the last epoch inside;
3. ``clean`` deletes what neither this manifest nor the one before it names.

A crash between any two steps leaves the old manifest with all that it names,
or the new one with all that it names.

``ingest_changes`` puts a stateful operator in front of the log: it remembers
each key's newest version and passes on real changes only. Its watermark bounds
the state; rows whose file is older than the newest one by more than
``late_after`` are dropped and counted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from ..session import hadoop_path, read_file, replace_file
from ..sources import snapshots as SN

RESULT_KEY = ["season", "round", "Driver.driverId"]
ARRIVAL = ["_file_time", "_page"]
EMPTY_MANIFEST = {"through": -1, "parts": {}, "before": {"through": -1, "parts": {}}}


def append_epoch(table_path: str):
    """The batch function: ``batch`` holds pages, with ``_file_time`` (a
    timestamp) where the source knows it."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        if "_file_time" not in batch.columns:
            batch = batch.withColumn("_file_time", F.lit(None).cast("timestamp"))
        _flat(batch).write.mode("overwrite").parquet(f"{table_path}/epoch={epoch_id}")
    return run


def _flat(pages: DataFrame) -> DataFrame:
    return SN.flatten_results(pages, [F.col("_file_time"), F.col("MRData.offset").cast("long").alias("_page")])


def _results(spark: SparkSession) -> DataFrame:
    return SN.flatten_results(spark.createDataFrame([], SN.PAGE))


def _log_schema(spark: SparkSession) -> StructType:
    return _results(spark).withColumns({"_file_time": F.lit(None).cast("timestamp"), "_page": F.lit(None).cast("long"),
                                        "epoch": F.lit(None).cast("long")}).schema


def latest(log: DataFrame) -> DataFrame:
    """The last row of each key, with its epoch and arrival; key parts may be null."""
    name = {c: F.col(f"`{c}`") for c in log.columns}
    rest = [name[c] for c in log.columns if c not in (*RESULT_KEY, "epoch", *ARRIVAL)]
    last = log.groupBy(*[name[k] for k in RESULT_KEY]).agg(F.max(F.struct("epoch", *ARRIVAL, F.struct(*rest).alias("row"))).alias("_last"))
    at = {c: f"_last.{c}" for c in ("epoch", *ARRIVAL)}
    return last.select(*[name[c] if c in RESULT_KEY else F.col(at.get(c, f"_last.row.`{c}`")).alias(c) for c in log.columns])


# ------------------------------------------------------------------ compaction
def manifest(spark: SparkSession, table_path: str) -> dict:
    text = read_file(spark, f"{table_path}/_manifest")
    return json.loads(text) if text else EMPTY_MANIFEST


def finished_epochs(spark: SparkSession, table_path: str, after: int) -> list[int]:
    """Numbers of the complete epoch folders behind ``after``."""
    fs, p = hadoop_path(spark, table_path)
    if not fs.exists(p):
        return []
    names = [s.getPath() for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith("epoch=")]
    found = {int(n.getName()[6:]): n for n in names}
    jvm = spark.sparkContext._jvm
    return sorted(e for e, n in found.items() if e > after and fs.exists(jvm.org.apache.hadoop.fs.Path(n, "_SUCCESS")))


def _epochs(spark: SparkSession, table_path: str, numbers: list[int]) -> DataFrame:
    return spark.read.schema(_log_schema(spark)).option("basePath", table_path).parquet(*[f"{table_path}/epoch={e}" for e in numbers])


def _parts(spark: SparkSession, table_path: str, parts: dict[str, str]) -> DataFrame:
    return spark.read.schema(_log_schema(spark)).parquet(*[f"{table_path}/_snapshots/{folder}" for folder in parts.values()])


def _part() -> Column:
    """The name of a row's season in the manifest."""
    return F.concat(F.lit("s"), F.coalesce(F.col("season"), F.lit("")))


def _touched(fresh: DataFrame) -> list[str]:
    """The seasons that new epochs have rows of."""
    return [r.p for r in fresh.select(_part().alias("p")).distinct().collect()]


def write_snapshot(spark: SparkSession, table_path: str) -> dict | None:
    """Step 1: the manifest that a compaction would publish, its folders
    written; None if there is no new epoch."""
    old = manifest(spark, table_path)
    epochs = finished_epochs(spark, table_path, old["through"])
    if not epochs:
        return None
    fresh = _epochs(spark, table_path, epochs)
    touched = _touched(fresh)
    known = {s: old["parts"][s] for s in touched if s in old["parts"]}
    rows = fresh.unionByName(_parts(spark, table_path, known)) if known else fresh
    folder = f"v-{uuid.uuid4().hex[:12]}"
    latest(rows).withColumn("_part", _part()).repartition("_part", F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in RESULT_KEY]), F.lit(8))) \
        .write.partitionBy("_part").parquet(f"{table_path}/_snapshots/{folder}")
    fs, p = hadoop_path(spark, f"{table_path}/_snapshots/{folder}")
    written = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
    jvm = spark.sparkContext._jvm  # folder names are escaped as in any partitioned table
    names = {jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(w[len("_part="):]): f"{folder}/{w}" for w in written}
    return {"through": epochs[-1], "parts": old["parts"] | names, "before": {k: old[k] for k in ("through", "parts")}}


def publish_manifest(spark: SparkSession, table_path: str, new: dict) -> None:
    """Step 2."""
    replace_file(spark, f"{table_path}/_manifest", json.dumps(new))


def clean(spark: SparkSession, table_path: str) -> int:
    """Step 3: delete epochs and snapshot folders that neither the manifest
    nor the one before it reads. Returns their number."""
    now = manifest(spark, table_path)
    if now == EMPTY_MANIFEST:
        return 0
    keep = {*now["parts"].values(), *now["before"]["parts"].values()}
    gone = 0
    for e in finished_epochs(spark, table_path, -1):
        if e <= now["before"]["through"]:
            fs, p = hadoop_path(spark, f"{table_path}/epoch={e}")
            gone += fs.delete(p, True)
    fs, p = hadoop_path(spark, f"{table_path}/_snapshots")
    for version in fs.listStatus(p) if fs.exists(p) else []:
        for s in fs.listStatus(version.getPath()):
            if s.isDirectory() and f"{version.getPath().getName()}/{s.getPath().getName()}" not in keep:
                gone += fs.delete(s.getPath(), True)
        if not any(s.isDirectory() for s in fs.listStatus(version.getPath())):
            fs.delete(version.getPath(), True)
    return gone


def compact(spark: SparkSession, table_path: str) -> dict:
    """All steps; one compaction at a time. Returns the manifest."""
    new = write_snapshot(spark, table_path)
    if new is not None:
        publish_manifest(spark, table_path, new)
        clean(spark, table_path)
    return new or manifest(spark, table_path)


def read_latest(spark: SparkSession, table_path: str) -> DataFrame:
    """The latest row of each key: the snapshot and the epochs behind it. Only
    the seasons that these epochs touch are aggregated; the snapshot has the
    latest rows of the others already."""
    empty = _results(spark)
    now = manifest(spark, table_path)
    epochs = finished_epochs(spark, table_path, now["through"])
    rest, out = dict(now["parts"]), None
    if epochs:
        fresh = _epochs(spark, table_path, epochs)
        known = {s: rest.pop(s) for s in _touched(fresh) if s in rest} if rest else {}
        out = latest(fresh.unionByName(_parts(spark, table_path, known)) if known else fresh)
    if rest:
        parts = _parts(spark, table_path, rest)
        out = parts if out is None else out.unionByName(parts)
    return empty if out is None else out.select(*[F.col(f"`{c}`") for c in empty.columns])


# --------------------------------------------------------------------- streams
def _pages(spark: SparkSession, incoming: str) -> DataFrame:
    stream = spark.readStream.schema(SN.PAGE).option("recursiveFileLookup", "true").json(incoming)
    return stream.select("*", F.col("_metadata.file_modification_time").alias("_file_time"))


def incremental_results_ingest(spark: SparkSession, incoming: str, table_path: str,
                               checkpoint: str) -> DataFrame:
    q = (_pages(spark, incoming).writeStream.foreachBatch(append_epoch(table_path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return read_latest(spark, table_path)


def changes(rows: DataFrame, late_after: str) -> DataFrame:
    """Of a stream of flattened results, the rows that are newer than what is
    known of their key and differ from it; at most one for each key and batch.

    State: time, page and fingerprint of each key's newest row, until the
    watermark has passed the row by ``late_after``; a key that comes back after
    that is a change again, which latest-row reads don't mind."""
    names = [c for c in rows.columns if c not in ARRIVAL]
    data = rows.withColumn("_print", F.xxhash64(*[F.col(f"`{c}`") for c in names])).withWatermark("_file_time", late_after)
    flat = [f"c{i}" for i in range(len(names))]  # dots in names would be taken for fields
    data = data.select(*[F.col(f"`{c}`").alias(f) for c, f in zip(names, flat, strict=True)], "_file_time", "_page", "_print")
    keys = [flat[names.index(k)] for k in RESULT_KEY]

    def newest(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        known, best = (state.get if state.exists else None), None
        for part in parts:
            part = part.assign(_page=part["_page"].fillna(-1).astype("int64")).sort_values(["_file_time", "_page"], kind="stable")
            if best is None or (part["_file_time"].iloc[-1], part["_page"].iloc[-1]) >= (best["_file_time"].iloc[-1], best["_page"].iloc[-1]):
                best = part.iloc[[-1]]
        at, page, mark = best["_file_time"].iloc[0].value // 1000, int(best["_page"].iloc[0]), int(best["_print"].iloc[0])
        if known is None or (at, page) > tuple(known[:2]):
            state.update((at, page, mark))
            if known is None or mark != known[2]:
                yield best
        state.setTimeoutTimestamp(max(at // 1000, state.getCurrentWatermarkMs()) + 1)

    schema = StructType([data.schema[c] for c in data.columns])
    out = data.groupBy(*keys).applyInPandasWithState(newest, schema, "at long, page long, mark long", "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(*[F.col(f).alias(c) for c, f in zip(names, flat, strict=True)], "_file_time", F.expr("nullif(_page, -1)").alias("_page"))


def ingest_changes(spark: SparkSession, incoming: str, table_path: str, checkpoint: str, late_after: str) -> tuple[DataFrame, int]:
    """As ``incremental_results_ingest`` with ``changes`` in front of the log;
    also the number of rows that came too late."""
    def append(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/epoch={epoch_id}")

    q = (changes(_flat(_pages(spark, incoming)), late_after).writeStream.foreachBatch(append)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    late = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    return read_latest(spark, table_path), late
