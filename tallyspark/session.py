"""Session helpers.

The library never creates a session behind the caller's back: every public
function takes a ``SparkSession`` or a ``DataFrame``.  ``local_session`` is the
helper used by tests, ``bench.py`` and examples; on a cluster the session comes
from ``spark-submit`` and only ``ensure_checkpoint_dir`` is applied.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tallyspark") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TALLY_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    on a local master (tests, a laptop) a scratch folder is created and
    registered. On a cluster a folder that all hosts share has to be named.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all hosts of {master} share")
    path = tempfile.mkdtemp(prefix="tallyspark-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


_STAGES: dict[str, list[str]] = {}


def materialize(df, tag: str):
    """Write ``df`` as a parquet table under the shared checkpoint folder and
    read it back: lineage is cut, the data survives executor loss, and later
    readers get column pruning and filter pushdown (an RDD checkpoint has
    neither)."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tables/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    _STAGES.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of any file system that Spark knows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text file in the place of ``path`` in one step: readers see
    the old or the new text, whatever happens in between. The text is written
    next to it first and renamed over it, which the file system does at once
    (local and HDFS); stores without renames replace the object on close."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, target = hadoop_path(spark, path)
    target = fs.makeQualified(target)
    fs.mkdirs(target.getParent())
    part = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}-{uuid.uuid4().hex[:12]}")
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    option = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(part, target, options)


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)  # not spark.read, which skips names that begin with an underscore
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def drop_stages(spark: SparkSession) -> int:
    """Delete the stage tables that this application wrote; call it when no
    result that reads them is needed any more. Returns their number."""
    paths = _STAGES.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        fs, p = hadoop_path(spark, path)
        fs.delete(p, True)
    return len(paths)


def data_version(spark: SparkSession, folder: str) -> tuple:
    """Names, lengths and times of the files of a folder and its tables, so
    that a memo by folder doesn't outlive its data."""
    fs, p = hadoop_path(spark, folder)
    out = []
    for s in fs.listStatus(p):
        for f in fs.listStatus(s.getPath()) if s.isDirectory() else [s]:
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))
