"""Dates, calendars and epoch times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_digit_year_date(text: Column, first_old_year: int) -> Column:
    """A date from 'M/d/yy'. Years from ``first_old_year`` up are 19yy, the others 20yy.

    Text of another shape, or a day that does not exist, gives NULL.
    """
    month, day, year = (F.regexp_extract(text, r"^(\d{1,2})/(\d{1,2})/(\d{2})$", i) for i in (1, 2, 3))
    century = F.when(year.try_cast("int") >= first_old_year, "19").otherwise("20")
    iso = F.concat(century, year, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"))
    return F.when(year != "", iso.try_cast("date"))


# The shell programs move 31-99 to 19yy, the notebook 30-99.
SHELL_PIVOT = 31
NOTEBOOK_PIVOT = 30


def epoch_columns(seconds: Column) -> dict[str, Column]:
    """Date and time of day, as text, of a Unix time in the session's zone (UTC)."""
    moment = F.timestamp_seconds(seconds)
    return {
        "full_date": F.date_format(moment, "yyyy-MM-dd"),
        "full_time": F.date_format(moment, "HH:mm:ss"),
    }


def calendar(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day from ``first`` to ``last``, two date columns of a one-row frame."""
    return bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("full_date"))


def calendar_span(spark, first: str, last: str) -> DataFrame:
    """One row per day between two ISO dates."""
    return calendar(
        spark.range(1).select(F.lit(first).cast("date").alias("a"), F.lit(last).cast("date").alias("b")),
        "a",
        "b",
    )


def sunday_week_attributes(days: DataFrame) -> DataFrame:
    """Warehouse calendar: day names, weekend flag, and weeks that start on Sunday (0-53)."""
    day = F.col("full_date")
    return days.select(
        "full_date",
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.date_format(day, "E").alias("day_of_week_short"),
        F.when(F.dayofweek(day).isin(1, 7), "Weekend").otherwise("Weekday").alias("is_weekday_or_weekend"),
        F.day(day).alias("day_of_month"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.month(day).alias("month"),
        F.dayofyear(day).alias("day_of_year"),
        F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("int").alias("week_of_year"),
        F.quarter(day).alias("quarter_number"),
        F.year(day).alias("year_number"),
    )


def iso_week_attributes(days: DataFrame) -> DataFrame:
    """Streaming calendar: Monday is 1, ISO weeks, the date as text."""
    day = F.col("full_date")
    return days.select(
        F.date_format(day, "yyyy-MM-dd").alias("full_date"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.date_format(day, "E").alias("day_of_week_short"),
        F.when(F.weekday(day) < 5, "Weekday").otherwise("Weekend").alias("is_weekday_or_weekend"),
        F.day(day).alias("day_of_month"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.month(day).alias("month"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.quarter(day).alias("quarter_number"),
        F.year(day).alias("year"),
    )
