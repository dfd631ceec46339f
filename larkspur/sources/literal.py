"""Small constant tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def literal_rows(spark: SparkSession, rows: Iterable[Sequence], schema: str | T.StructType) -> DataFrame:
    """Constant rows as a table.

    The rows travel as Arrow inside the plan, so the optimizer knows their size and
    broadcasts them by itself, and no Python worker is started to read them.
    """
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) or [()] * len(arrow)
    arrays = [pa.array(list(column), type=field.type) for column, field in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)
