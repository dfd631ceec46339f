"""Row-level helpers shared by several queries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.sources.literal import literal_rows


def split_rows(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, all other rows); a NULL predicate counts as not passed."""
    passed = F.coalesce(predicate, F.lit(False))
    return df.where(passed), df.where(~passed)


def null_count(columns: Iterable[str]) -> Column:
    """How many of the columns are NULL in a row."""
    return reduce(lambda a, b: a + b, (F.col(x).isNull().cast("int") for x in columns))


def sentinels_to_null(df: DataFrame, columns: Sequence[str], sentinels: Sequence[str]) -> DataFrame:
    """Blank text and the given marks become NULL in the named string columns."""
    return df.withColumns(
        {x: F.when((F.trim(x) != "") & ~F.col(x).isin(*sentinels), F.col(x)) for x in columns}
    )


def with_unknown_member(df: DataFrame, key: str, key_value, default: str = "XNA") -> DataFrame:
    """The rows plus one row that stands for 'unknown': the key value, a default in text columns, NULL in others."""
    fields = [T.StructField(f.name, f.dataType) for f in df.schema.fields]
    values = [key_value if f.name == key else default if isinstance(f.dataType, T.StringType) else None for f in fields]
    unknown = literal_rows(df.sparkSession, [values], T.StructType(fields))
    return df.unionByName(unknown)
