"""The event transform, shared by batch and stream, and the record-level steps around it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions import dates, keys, web
from larkspur.functions.nested import CLICK_SCHEMA, parse_json


def as_text(records: DataFrame) -> DataFrame:
    """Key and value bytes to strings; the other record columns stay."""
    return records.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})


def enrich(records: DataFrame, schema: T.StructType = CLICK_SCHEMA) -> DataFrame:
    """Parsed messages with hash keys, date and time texts, referrer domain, browser and system.

    A message that cannot be read gives a row of NULLs; its sales key is NULL, too, so the
    fact load leaves it out. All steps are built-in expressions, on a batch or a stream.
    """
    data = parse_json(records, "value", schema)
    return data.withColumns(
        {
            "option": F.to_json("option"),
            **dates.epoch_columns(F.col("time_stamp")),
            "sales_key": keys.sales_key(F.col("id"), F.col("product_id")),
            "ip_key": keys.sha_key(F.col("ip")),
            "user_agent_key": keys.sha_key(F.col("user_agent")),
            "product_key": F.col("product_id").cast("string"),
            "referrer_url": web.authority(F.col("referrer_url")),
            "browser": web.browser(F.col("user_agent")),
            "os": web.operating_system(F.col("user_agent")),
        }
    )


def present(records: DataFrame) -> DataFrame:
    """Records with a value; the others carry nothing to pass on."""
    return records.where(F.col("value").isNotNull())


def relay(records: DataFrame) -> DataFrame:
    """Records for another topic: same key, same value, values that are missing skipped."""
    return present(records).select("key", "value")


def _is_document(text):
    kind = F.schema_of_variant(F.try_parse_json(text))
    return kind.startswith("OBJECT")


def documents(records: DataFrame) -> DataFrame:
    """Readable messages as stored documents, with where they came from and when they were processed."""
    text = F.col("value").cast("string")
    return present(records).where(_is_document(text)).select(
        text.alias("document"),
        F.col("key").cast("string").alias("_kafka_key"),
        F.col("topic").alias("_kafka_topic"),
        F.col("partition").alias("_kafka_partition"),
        F.col("offset").alias("_kafka_offset"),
        F.current_timestamp().alias("_processed_at"),
    )


def dead_letters(records: DataFrame) -> DataFrame:
    """Messages with a value that is no JSON object."""
    text = F.col("value").cast("string")
    bad = ~F.coalesce(_is_document(text), F.lit(False))
    return present(records).where(bad).select(text.alias("value"), "topic", "partition", "offset")


def words(lines: DataFrame, column: str) -> DataFrame:
    """One row per blank-separated word."""
    return lines.select(F.explode(F.split(column, " ")).alias("word"))


def word_counts(lines: DataFrame, column: str) -> DataFrame:
    return words(lines, column).groupBy("word").agg(F.count("*").alias("count"))


def even_words(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("count") % 2 == 0)


def odd_long_words(counts: DataFrame) -> DataFrame:
    return counts.where((F.col("count") % 2 == 1) & (F.length("word") > 1))
