"""Page-view reports that a stream keeps up to date: hourly counts with a bound on how late an event may come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions import dates, web
from larkspur.functions.nested import CLICK_SCHEMA, parse_json
from larkspur.operators import versions
from larkspur.streaming import sinks

#: The fields that the reports use; the others are not read out of a message.
_FIELDS = ["time_stamp", "product_id", "store_id", "current_url", "referrer_url", "user_agent"]
_SCHEMA = T.StructType([f for f in CLICK_SCHEMA.fields if f.name in _FIELDS])

KEYS = ["hour_start", "report", "first", "second"]
COUNTS = "hour_start timestamp, report string, first string, second string, count bigint, _batch bigint"
#: What is counted: a report's name and the one or two columns that it counts by.
REPORTS = {
    "product": ("product_id", None), "country": ("country", None), "referrer": ("referrer_url", None), "store": ("country", "store_id"),
    "client": ("browser", "os"),
}


def page_views(records: DataFrame) -> DataFrame:
    """Readable messages with time, page country, referrer domain, browser and system, on a batch or a stream."""
    read = parse_json(records, "value", _SCHEMA)
    seen = {"event_time": F.timestamp_seconds("time_stamp"), **dates.epoch_columns(F.col("time_stamp")), "country": web.domain_suffix(F.col("current_url"))}
    client = {"browser": web.browser(F.col("user_agent")), "os": web.operating_system(F.col("user_agent"))}
    told = {"hour": F.substring("full_time", 1, 2), "referrer_url": web.authority(F.col("referrer_url"))}
    return read.withColumns({**seen, **client}).withColumns(told)


def hourly_counts(views: DataFrame, delay: str) -> DataFrame:
    """Views by hour, report and its columns. On a stream, an event later than ``delay`` behind the latest is left out.

    An hour's counts leave the state once the latest event is ``delay`` past its end, so the state is as large as that
    span, however long the stream.
    """
    one = [
        F.struct(F.lit(name).alias("report"), F.col(first).alias("first"), (F.col(second) if second else F.lit(None).cast("string")).alias("second"))
        for name, (first, second) in REPORTS.items()
    ]
    timed = views.where("event_time is not null").withWatermark("event_time", delay)
    told = timed.select("event_time", F.explode(F.array(*one)).alias("r")).select("event_time", "r.*")
    hour = F.window("event_time", "1 hour")
    return told.groupBy(hour, "report", "first", "second").agg(F.count("*").alias("count")).select(
        F.col("window.start").alias("hour_start"), "report", "first", "second", "count"
    )


def create(spark: SparkSession, root: str) -> None:
    versions.create(spark, root, {"views": COUNTS})


def keep_counts(records: DataFrame, root: str, checkpoint: str, delay: str = "2 hours"):
    """Start the stream that keeps the counts in the store at ``root``: of every batch only changed counts are written."""
    changed = hourly_counts(page_views(records), delay)
    return sinks.start(changed, checkpoint, batch=sinks.changes_into(root, "views", KEYS, checkpoint), mode="update")


def counts_of(spark: SparkSession, root: str, report: str, day: str) -> DataFrame:
    """The stored counts of one report and day: ``first, second, hour, views``."""
    stored = sinks.read_changes(spark, root, "views", KEYS)
    one = stored.where((F.col("report") == report) & (F.to_date("hour_start") == F.lit(day).cast("date")))
    return one.select("first", "second", F.date_format("hour_start", "HH").alias("hour"), F.col("count").alias("views"))


def top(spark: SparkSession, root: str, report: str, day: str, n: int) -> DataFrame:
    """The first ``n`` values of a report of one column by views of the day; ties go to the smaller value."""
    counts = counts_of(spark, root, report, day).where("first is not null").groupBy("first").agg(F.sum("views").alias("views"))
    return counts.orderBy(F.desc("views"), "first").limit(n)
