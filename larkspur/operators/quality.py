"""Data tests: each returns the offending rows or their number."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_unique(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once; empty if the key is unique."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("count")).where("count > 1")


def is_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def key_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per table and test (unique, not_null) with the number of failures; each table is read once."""
    parts = []
    for name, (df, key) in tables.items():
        counted = df.groupBy(key).agg(F.count("*").alias("n"))
        missing = F.col(key).isNull()
        tests = counted.agg(
            F.count_if(~missing & (F.col("n") > 1)).alias("unique"),
            F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).cast("bigint").alias("not_null"),
        ).unpivot([], ["unique", "not_null"], "test", "failures")
        parts.append(tests.select(F.lit(name).alias("table"), F.lit(key).alias("column"), "test", "failures"))
    return reduce(DataFrame.unionByName, parts)


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule with the number of rows that break it, from one pass.

    A rule that is NULL for a row counts as broken.
    """
    counts = df.agg(*[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def salary_rules() -> dict[str, Column]:
    """The three rules that cleaned salaries must keep."""
    low, high, negotiable = F.col("salary_min"), F.col("salary_max"), F.col("negotiable")
    return {
        "unit present": F.col("salary_unit").isNotNull(),
        "fixed salary has a bound": negotiable | low.isNotNull() | high.isNotNull(),
        "negotiable has no bound": ~negotiable | (low.isNull() & high.isNull()),
    }


def assert_rules(report: DataFrame) -> None:
    """Raise if any rule of a violation report is broken; a report has one row per rule."""
    broken = [f"{r['rule']}: {r['violations']}" for r in report.where("violations > 0").collect()]
    if broken:
        raise AssertionError("; ".join(broken))

