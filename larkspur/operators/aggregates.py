"""Aggregations and statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.ordered import exact_percentiles


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [
        df.agg(F.count("*").alias("row_num")).select(F.lit(name).alias("tables"), "row_num")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def null_counts_wide(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """One row: for each column the number of NULLs, under the given output names."""
    return df.agg(*[F.count_if(F.col(x).isNull()).alias(out) for x, out in names.items()])


def null_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with a NULL_OCCUR or NO_NULL label, from a single pass over the table."""
    wide = null_counts_wide(df, {x: x for x in columns})
    long = wide.unpivot([], list(columns), "column_name", "count_null")
    label = F.when(F.col("count_null") > 0, "NULL_OCCUR").otherwise("NO_NULL")
    return long.select("column_name", label.alias("check_null"))


def weighted_average(value: str | Column, weight: str | Column) -> Column:
    """sum(value * weight) / sum(weight). A NULL value is left out above and kept below the line."""
    value = F.col(value) if isinstance(value, str) else value
    weight = F.col(weight) if isinstance(weight, str) else weight
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(name))


def most_frequent(df: DataFrame, column: str, n: int = 1, name: str = "count") -> DataFrame:
    """The n most frequent non-null values; equal counts go by value."""
    counts = value_counts(df.where(F.col(column).isNotNull()), column, name)
    return counts.orderBy(F.desc(name), F.asc(column)).limit(n)


def most_frequent_per(df: DataFrame, parent: str, child: str, name: str = "count") -> DataFrame:
    """The most frequent child of every parent, the first by name among equals."""
    counts = df.groupBy(parent, child).agg(F.count("*").alias(name))
    order = Window.partitionBy(parent).orderBy(F.desc(name), F.asc(child))
    return counts.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def rows_at_extremes(df: DataFrame, column: str) -> DataFrame:
    """All rows that hold the column's overall minimum or maximum."""
    ends = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    ends = ends.select(F.explode(F.array("lo", "hi")).alias(column)).distinct()
    return df.join(ends, column, "left_semi").select(*df.columns)


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of every row value by the listed column values, 0 where a pair does not occur."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1))).na.fill(0)


def box_plot(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Quartiles and whiskers per group; whiskers end at the last value within 1.5 box heights.

    The quartiles are selected by histograms, and the whiskers are an aggregate of one more pass over the two columns.
    """
    by = list(by)
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*by, value)
    box = exact_percentiles(rows, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    box = box.select(*[F.col(b).alias(f"_{b}") for b in by], "q1", "median", "q3")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    on = reduce(lambda a, b: a & b, (F.col(b).eqNullSafe(F.col(f"_{b}")) for b in by), F.lit(True))
    return (
        rows.join(box, on)
        .where(inside)
        .groupBy(*by, "q1", "median", "q3")
        .agg(F.min(value).alias("whisker_low"), F.max(value).alias("whisker_high"))
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).where("count > 1")


def duplicated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key combination occurs more than once."""
    repeated = duplicate_keys(df, keys)
    on = reduce(lambda a, b: a & b, (df[k].eqNullSafe(repeated[k]) for k in keys))
    return df.join(repeated, on, "left_semi")


def lists_per_key(df: DataFrame, key: str, value: str, chunk: int = 1000) -> DataFrame:
    """The distinct values of each key, as sorted arrays of about ``chunk`` values.

    A key with few values has one array (``part`` 0 of ``parts`` 1). A key with many is
    cut by a hash of the value, so no array and no task grows with the key; the arrays
    of a key together hold all its values.
    """
    pairs = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).select(key, value).distinct()
    parts = pairs.groupBy(key).agg(F.ceil(F.count("*") / chunk).alias("parts"))
    number = F.conv(F.substring(F.md5(F.col(value).cast("string")), 1, 7), 16, 10).cast("bigint")
    return (
        pairs.join(parts, key)
        .groupBy(key, (number % F.col("parts")).alias("part"), "parts")
        .agg(F.array_sort(F.collect_list(value)).alias("values"))
    )


def above_group_mean(df: DataFrame, by: str, value: str, name: str = "above_mean") -> DataFrame:
    """Every row, and whether its value lies above the mean of its group, compared in the value's own type."""
    mean = df.groupBy(F.col(by).alias("_g")).agg(F.avg(value).alias("_mean"))
    return (
        df.join(mean, F.col(by).eqNullSafe(F.col("_g")))
        .withColumn(name, F.col(value) > F.col("_mean"))
        .drop("_g", "_mean")
    )


def second_extremes(df: DataFrame, by: str, value: str) -> DataFrame:
    """Second smallest and second largest distinct value of each group that has two.

    One sum of distinct values, then one of their two ends; no group is sorted or gathered.
    """
    distinct = df.where(F.col(value).isNotNull()).select(by, value).distinct()
    ends = distinct.groupBy(F.col(by).alias("_g")).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    inner = distinct.join(ends, F.col(by).eqNullSafe(F.col("_g")))
    return (
        inner.groupBy(by)
        .agg(
            F.min(F.when(F.col(value) > F.col("_lo"), F.col(value))).alias("second_min"),
            F.max(F.when(F.col(value) < F.col("_hi"), F.col(value))).alias("second_max"),
        )
        .where("second_min is not null")
    )


def field_stats(df: DataFrame, column: str) -> DataFrame:
    """Minimum, maximum and mean of a whole-number column."""
    mean = F.sum(F.col(column).cast("decimal(38,0)")).cast("double") / F.count(column)
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"), mean.alias("avg_value"))


def empty_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per text column: how often it is missing (NULL) and how often empty."""
    aggs = []
    for x in columns:
        aggs += [F.count_if(F.col(x).isNull()).alias(f"{x}|missing"), F.count_if(F.col(x) == "").alias(f"{x}|empty")]
    long = df.agg(*aggs).unpivot([], [f"{x}|{k}" for x in columns for k in ("missing", "empty")], "what", "n")
    return long.select(F.split_part("what", F.lit("|"), F.lit(1)).alias("field"),
                       F.split_part("what", F.lit("|"), F.lit(2)).alias("kind"), "n")


def finite_or_null(column: Column) -> Column:
    """NaN and infinities to NULL."""
    return F.when(F.abs(column) < F.lit(float("inf")), column)


def ratio_percent(part: Column, whole: Column) -> Column:
    """part / whole * 100 with IEEE results for a zero divisor: infinities, and NULL for 0 / 0."""
    by_zero = F.when(part > 0, float("inf")).when(part < 0, float("-inf"))
    return F.when(whole == 0, by_zero).otherwise(F.try_divide(part, whole) * 100)
