"""Table scans (S2-S4) and the load-time profile (S3)."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TESTDATA_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def read_optional(spark: SparkSession, path: str, schema: StructType,
                  fmt: str = "parquet", **options) -> DataFrame:
    """A missing source yields an empty table with the declared schema."""
    if not _path_exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).options(**options)
    return reader.format(fmt).load(path)


def load_tables(spark: SparkSession, data_dir: str, required: Iterable[str],
                optional: Iterable[str] = (), fmt: str = "parquet",
                schemas: dict[str, StructType] | None = None) -> dict[str, DataFrame]:
    """Load every table of a directory, fail if a required one is absent.

    CSV sources use ``\\N`` as the null marker and an explicit schema when one
    is given (no inference on large inputs).
    """
    schemas = schemas or {}
    ext = {"parquet": "parquet", "csv": "csv", "json": "json"}[fmt]
    tables: dict[str, DataFrame] = {}
    missing = []
    for name in list(required) + list(optional):
        path = os.path.join(data_dir, f"{name}.{ext}")
        if not _path_exists(spark, path):
            if name in required:
                missing.append(name)
            continue
        reader = spark.read
        if name in schemas:
            reader = reader.schema(schemas[name])
        if fmt == "csv":
            reader = reader.option("header", True).option("nullValue", "\\N")
            if name not in schemas:
                reader = reader.option("inferSchema", True)
        tables[name] = reader.format(fmt).load(path)
    if missing:
        raise FileNotFoundError(f"required tables missing in {data_dir}: {sorted(missing)}")
    return tables


def load_profile(tables: dict[str, DataFrame], top: int = 3) -> DataFrame:
    """S3: rows, columns and the ``top`` highest null rates per table.

    One aggregate pass per table (count + avg(isNull) for every column), the
    single-row results are unpivoted to long form and ranked per table.
    """
    parts = []
    for name, df in tables.items():
        cols = df.columns
        agg = df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(f"null__{i}")
              for i, c in enumerate(cols)],
        )
        stack = ", ".join(f"'{c}', null__{i}" for i, c in enumerate(cols))
        long = agg.selectExpr(
            f"'{name}' as table_name", "n_rows", f"{len(cols)} as n_cols",
            f"stack({len(cols)}, {stack}) as (column_name, null_rate)")
        parts.append(long)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    from pyspark.sql import Window
    w = Window.partitionBy("table_name").orderBy(F.desc("null_rate"), F.asc("column_name"))
    return (out.withColumn("null_rank", F.row_number().over(w))
               .filter(F.col("null_rank") <= top)
               .withColumn("null_rate", F.round("null_rate", 6)))
