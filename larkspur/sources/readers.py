"""File, table and message readers. Schemas are given, never inferred: inference reads the data twice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Schema = str | T.StructType


def read_csv(spark: SparkSession, path: str, schema: Schema, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """CSV with a header; quoted fields may hold separators and doubled quotes.

    Fields with line breaks need ``multiLine=True``. Each file is then read by one task, so
    such exports are written in files of limited size.
    """
    reader = spark.read.schema(schema).options(header=True, quote='"', escape='"', enforceSchema=False)
    df = reader.options(**options).csv(path)
    return df.select(*columns) if columns else df


def read_json(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """A folder of JSON lines."""
    return spark.read.schema(schema).json(path)


def read_json_arrays(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """Files that each hold one JSON array, or one object."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_files(spark: SparkSession, fmt: str, path: str, schema: Schema | None = None, **options) -> DataFrame:
    """Any file format, among them parquet, orc, avro (with its package), text and binaryFile."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    name: str,
    properties: Mapping[str, str],
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    limit: int | None = None,
    date_columns: Sequence[str] = (),
) -> DataFrame:
    """A database table. With a numeric key and its bounds, executors read it in ``partitions`` slices;
    the bounds only place the cuts, no row is left out."""
    options = {**properties, "url": url, "dbtable": name}
    if key and bounds:
        options |= {
            "partitionColumn": key, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    df = spark.read.format("jdbc").options(**options).load()
    return parse_dates(df.limit(limit) if limit is not None else df, date_columns)


def parse_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns to timestamps; unreadable text gives NULL."""
    return df.withColumns({x: F.try_to_timestamp(F.col(x)) for x in columns})


def read_table(spark: SparkSession, name: str, limit: int | None = None, date_columns: Sequence[str] = ()) -> DataFrame:
    """A catalog table, all rows or the first ``limit``."""
    df = spark.table(name)
    return parse_dates(df.limit(limit) if limit is not None else df, date_columns)


def read_stream(spark: SparkSession, fmt: str, options: Mapping[str, str], schema: Schema | None = None) -> DataFrame:
    """A stream; for ``kafka`` the options carry servers, topics, security and starting offsets."""
    reader = spark.readStream.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load()


def kafka_options(servers: str, topics: str, start: str = "latest", user: str | None = None, password: str | None = None, **more) -> dict[str, str]:
    """Options of a Kafka source, with SASL login if a user is given."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topics, "startingOffsets": start, **more}
    if user is not None:
        login = "org.apache.kafka.common.security.plain.PlainLoginModule required"
        options |= {
            "kafka.security.protocol": "SASL_PLAINTEXT",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": f'{login} username="{user}" password="{password}";',
        }
    return options


def query_with(spark: SparkSession, sql: str, args: Mapping[str, object] | None = None, **frames: DataFrame) -> DataFrame:
    """SQL text with named parameters (``:name``) and frames (``{name}``); values are never pasted into the text."""
    return spark.sql(sql, args=dict(args or {}), **frames)
