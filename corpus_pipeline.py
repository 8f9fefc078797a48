"""Corpus pipeline: stages over ``documents``, each written as Parquet and read
again as the next one's input.

All but the last return the columns of ``documents``; a stage works on every
row that its predecessor kept.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import (catalog, common, op3_token_records, op4_mixing, op5_decontaminate, op8_language,
                            op10_hyperminhash)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in no known language, go."""
    return op8_language.accepted(docs, op8_language.identify(docs, op8_language.train(docs)))


def numbered(docs: DataFrame) -> DataFrame:
    """``row`` (all columns, so that no name can clash) and a ``number`` for
    each row: the id where ids are unique, else a stored one. Stages decide by
    it, so that rows which share an id or have none are judged one by one."""
    ids = docs.groupBy("doc_id").count()
    if ids.where("count > 1 OR doc_id IS NULL").isEmpty():
        return docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("number"))
    return common.store(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number")), "pipeline-rows")


def _as_documents(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text"), F.col("row.source").alias("source"))


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose number is not in the column ``gone``."""
    return rows.join(common.hinted(gone), rows.number == gone.gone, "left_anti").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the smallest id, rows
    without an id last, of equal ids the first stored."""
    rows = numbered(docs)
    judged = common.store(op10_hyperminhash.near_duplicates(_as_documents(rows)), "pipeline-near").select(F.col("doc_id").alias("gone"), "component_id")
    copies = judged.where("gone <> component_id").select("component_id").distinct()
    groups = judged.join(common.hinted(copies), "component_id", "left_semi")
    groups = groups.join(rows.select("number", F.col("row.doc_id").alias("id")), groups.gone == F.col("number"))
    rank = F.struct(F.col("id").isNull(), "id", "number")
    first = groups.groupBy("component_id").agg(F.min(rank).alias("first")).select(F.col("first.number").alias("stays"))
    return _without(rows, common.store(groups.join(first, F.col("gone") == F.col("stays"), "left_anti").select("gone"), "pipeline-gone"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a test item go."""
    rows = numbered(docs)
    hits = op5_decontaminate.contaminated(_as_documents(rows), catalog.table(spark, sf_dir, "benchmark"))
    return _without(rows, common.store(hits.select(F.col("doc_id").alias("gone")).distinct(), "pipeline-leaks"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: taken / size copies, a rest
    below one by a draw from its number."""
    rows = numbered(docs)
    mixed = op4_mixing.mix(_as_documents(rows))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("copy:"), F.col("doc_id").cast("string"))), 1, 8), 16, 10) / float(1 << 32)
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + draw)).otherwise(0).cast("int")
    times = common.hinted(common.store(mixed.select(F.col("doc_id").alias("of"), copies.alias("copies")).where("copies > 0"), "pipeline-mix"))
    taken = rows.join(times, rows.number == times.of)
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records, written and read back."""
    return op3_token_records.token_records(spark, docs, catalog.tokenizer_path(), end_id=2)


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", token_records),
]

#: The stages train models, hash sets and run a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = common.store(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
