"""Named queries, each kept next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larkspur.session import spread, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """Attribute access to the given tables: ``t.orders`` reads orders.parquet.

    Days and hours are those of UTC, so the session is set to it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def spread(self, name: str, *columns: str, most: int | None = None) -> DataFrame:
        """Columns of a table, handed to all cores where the table has few files, or with ``most`` rows to a task."""
        return spread(table(self.spark, self.sf_dir, name).select(*columns), most)


def query(name: str, sql: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under a name, with its check SQL if it has one."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register
