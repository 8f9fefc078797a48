"""Readers that lose no row (S2, P4): what can't be used is set aside with its
reason instead of being dropped or nulled in silence.

Text sources are read permissively, as strings, with Spark's corrupt-record
column carried along. ``judge`` types each column with ``try_cast``: a record
that can't be split into columns, or whose key is missing or of the wrong type,
is rejected whole; any other value of the wrong type becomes null (P4) and is
listed. Kept rows, rejected rows and nulled values come from one pass over the
same judged rows, and ``totals`` shows that they add up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"
FILE = "_file"


def read_text_table(spark: SparkSession, path: str, columns: Sequence[str], fmt: str = "csv", null_marker: str = "\\N", **options) -> DataFrame:
    """All columns as strings, the corrupt record (null for sound ones) and
    the file that each row comes from."""
    schema = StructType([*[StructField(c, StringType()) for c in columns], StructField(CORRUPT, StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).options(**options)
    if fmt == "csv":
        reader = reader.option("header", options.get("header", True)).option("nullValue", null_marker).option("enforceSchema", True)
    return reader.format(fmt).load(path).withColumn(FILE, F.col("_metadata.file_path"))


def _typed(name: str, kind: str) -> Column:
    return F.trim(F.col(f"`{name}`")).try_cast(kind) if kind != "string" else F.col(f"`{name}`")


def judge(text: DataFrame, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """``row`` (typed), ``reasons`` (why it is rejected; empty for kept rows),
    ``nulled`` (column and text of values of the wrong type), ``record`` (the
    source as JSON, or the corrupt line) and ``file``."""
    corrupt = F.col(CORRUPT) if CORRUPT in text.columns else F.lit(None).cast("string")
    file = F.col(FILE) if FILE in text.columns else F.lit(None).cast("string")
    wrong = {f.name: F.col(f"`{f.name}`").isNotNull() & _typed(f.name, f.dataType.simpleString()).isNull() for f in schema}
    reason = [F.when(corrupt.isNotNull(), F.lit("malformed record"))]
    for k in keys:
        reason.append(F.when(corrupt.isNull(), F.when(F.col(f"`{k}`").isNull(), F.lit(f"missing key {k}"))
                             .when(wrong[k], F.lit(f"key {k} is no {schema[k].dataType.simpleString()}"))))
    nulled = [F.when(wrong[f.name], F.struct(F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`").alias("text"))) for f in schema if f.name not in keys]
    none = F.array().cast("array<struct<column_name:string,text:string>>")
    return text.select(
        F.struct(*[_typed(f.name, f.dataType.simpleString()).alias(f.name) for f in schema]).alias("row"),
        F.array_compact(F.array(*reason)).alias("reasons"), F.array_compact(F.array(*nulled)).alias("nulled") if nulled else none.alias("nulled"),
        F.coalesce(corrupt, F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in schema]))).alias("record"), file.alias("file"))


def kept(judged: DataFrame) -> DataFrame:
    return judged.where(F.size("reasons") == 0).select("row.*")


def rejects(judged: DataFrame) -> DataFrame:
    """level (row or value), column_name, reason, text, record, file: one row
    for each reason of a rejected record and each nulled value of a kept one."""
    rows = judged.where(F.size("reasons") > 0).select(F.lit("row").alias("level"), F.lit(None).cast("string").alias("column_name"),
                                                      F.explode("reasons").alias("reason"), F.lit(None).cast("string").alias("text"), "record", "file")
    values = judged.where(F.size("reasons") == 0).select(F.explode("nulled").alias("v"), "record", "file")
    return rows.unionByName(values.select(F.lit("value").alias("level"), "v.column_name", F.lit("wrong type").alias("reason"), "v.text", "record", "file"))


def totals(judged: DataFrame) -> DataFrame:
    """One row: n_read = n_kept + n_rejected, and n_nulled values among the kept."""
    bad = F.size("reasons") > 0
    return judged.agg(F.count(F.lit(1)).alias("n_read"), F.count_if(~bad).alias("n_kept"), F.count_if(bad).alias("n_rejected"),
                      F.coalesce(F.sum(F.when(~bad, F.size("nulled"))), F.lit(0)).cast("bigint").alias("n_nulled"))
