"""Table profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators.ordered import exact_percentiles
from larkspur.sources.literal import literal_rows


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: type and non-null count, and for numbers mean, spread and exact quartiles.

    Two passes over the table: one aggregate for all columns, one for the quartiles of
    all numeric columns together.
    """
    spark = df.sparkSession
    types = literal_rows(
        spark, [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column string, type string"
    )
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    counted = df.agg(*[F.count(x).alias(x) for x in df.columns]).unpivot([], df.columns, "column", "non_null")
    profile = types.join(counted, "column")
    if not numbers:
        return profile
    values = df.select(*[F.col(x).cast("double").alias(x) for x in numbers]).unpivot([], numbers, "column", "x")
    moments = values.groupBy("column").agg(
        F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max")
    )
    quartiles = exact_percentiles(values, "x", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["column"])
    return profile.join(moments, "column", "left").join(quartiles, "column", "left").select(
        "column", "type", "non_null", "mean", "std", "min", "q1", "median", "q3", "max"
    )


def rows_per_partition(df: DataFrame) -> DataFrame:
    return df.groupBy(F.spark_partition_id().alias("partition")).count()
