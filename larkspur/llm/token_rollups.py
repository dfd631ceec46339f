"""Token counts kept by deltas: signed changes add up to totals by source, language and tokenizer version.

A batch of changes is summed before it is stored, so the store holds a few rows for each batch and never
the documents. A batch counts once, whatever happens to the writer: its sums go to a folder of
their own, and only a row in the log, written last, makes that folder count. A batch that is sent again is
left out; if two writers send it at once, the log has two rows for it and the first folder by name counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.session import new_folder

KEYS = ("source", "lang", "version")
_LOG = "batch string, run string"
_SUMS = "source string, lang string, version string, documents bigint, tokens bigint, run string"


def create_store(spark: SparkSession, folder: str | None = None) -> str:
    """An empty store in the folder, by default a new one in the shared folder; returns its path."""
    folder = folder or new_folder(spark, "rollups")
    spark.createDataFrame([], _LOG).write.mode("append").parquet(f"{folder}/log")
    spark.createDataFrame([], _SUMS).write.mode("append").parquet(f"{folder}/sums")
    return folder


def inserted(docs: DataFrame, version: str, tokens: Column) -> DataFrame:
    """Changes that count the documents with their tokens, one for each row; a null count is 0.

    Null sources and languages are kept, repeated rows count each, no rows give no changes. Only ``source``, ``lang`` and
    what ``tokens`` names are read, so further columns may have any names.
    """
    return _signed(docs, version, 1, tokens)


def deleted(docs: DataFrame, version: str, tokens: Column) -> DataFrame:
    """Changes that take the documents back with the tokens they were counted with; rows are read as by ``inserted``.

    Nothing is looked up: what was never counted goes below 0 and is shown so.
    """
    return _signed(docs, version, -1, tokens)


def revised(docs: DataFrame, version: str, old: Column, new: Column) -> DataFrame:
    """Changes that replace the documents' counts; the number of documents stays. Rows are read as by ``inserted``."""
    return deleted(docs, version, old).unionByName(inserted(docs, version, new))


def _signed(docs: DataFrame, version: str, sign: int, tokens: Column) -> DataFrame:
    return docs.select(
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.lit(version).alias("version"),
        F.lit(sign).cast("bigint").alias("documents"), (sign * F.coalesce(tokens.cast("bigint"), F.lit(0))).alias("tokens"),
    )


def commit(spark: SparkSession, store: str, batch: str, changes: DataFrame) -> bool:
    """Add a batch of changes to the store; False if it is there already. An empty batch is logged too."""
    if spark.read.schema(_LOG).parquet(f"{store}/log").where(F.col("batch") == batch).take(1):
        return False
    run = uuid.uuid4().hex
    sums = changes.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    sums.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{store}/sums")
    spark.createDataFrame([(batch, run)], _LOG).coalesce(1).write.mode("append").parquet(f"{store}/log")
    return True


def totals(spark: SparkSession, store: str) -> DataFrame:
    """``source, lang, version, documents, tokens`` over all committed batches.

    A null source or language is a group of its own. Groups whose documents and tokens have both gone back to 0 are left out.
    """
    committed = spark.read.schema(_LOG).parquet(f"{store}/log").groupBy("batch").agg(F.min("run").alias("run"))
    sums = spark.read.schema(_SUMS).parquet(f"{store}/sums").join(committed.select("run"), "run")
    return (
        sums.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        .where("documents != 0 or tokens != 0")
    )
