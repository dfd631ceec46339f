"""Joins that need more than ``DataFrame.join``: ranges, address tagging, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.text import fold_accents
from larkspur.functions.web import address_key
from larkspur.operators.ordered import carried, running_sums
from larkspur.sources.literal import literal_rows

def overlap_counts(intervals: DataFrame, low: str, high: str, points: DataFrame, point: str) -> DataFrame:
    """For every distinct point, how many closed intervals contain it.

    Both columns are whole numbers (use ``unix_date`` for days). Intervals that contain
    p are those that start at or before p, less those that end before p, so starts and
    ends are counted per value and summed along the axis. No pairs are formed, and long
    intervals cost no more than short ones. An interval without one of its ends, or whose
    end lies before its start, contains nothing.
    """
    start, ask, end = 0, 1, 2
    intervals = intervals.where(F.col(low) <= F.col(high))

    def marks(df: DataFrame, column: str, kind: int, change: Column) -> DataFrame:
        place = F.col(column).cast("bigint") * 3 + kind
        return df.where(F.col(column).isNotNull()).groupBy(place.alias("place")).agg(change.alias("change"))

    steps = (
        marks(intervals, low, start, F.count("*"))
        .unionByName(marks(points, point, ask, F.lit(0).cast("bigint")))
        .unionByName(marks(intervals, high, end, -F.count("*")))
    )
    summed = running_sums(steps, [], "place", ["change"])
    return summed.where(F.pmod(F.col("place"), F.lit(3)) == ask).select(
        ((F.col("place") - ask) / 3).cast("bigint").alias(point),
        F.col("change_before").cast("bigint").alias("overlaps"),
    )


def _end_of(ranges: DataFrame, column: str) -> Column:
    """A range's end as an address key: a number is an IPv4 address, text is any address."""
    if isinstance(ranges.schema[column].dataType, T.StringType):
        return address_key(F.col(column))
    return F.concat(F.lit("00000000000000000000ffff"), F.lower(F.lpad(F.hex(F.col(column).cast("bigint")), 8, "0")))


def locate_ips(addresses: DataFrame, ip: str, ranges: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Location columns for every distinct IPv4 or IPv6 address, NULL where no range holds it.

    ``ranges`` has ``ip_from`` and ``ip_to`` as IPv4 numbers or as text, without overlaps. An as-of join: starts of ranges and
    distinct addresses are laid out in one order, and each address takes the last start before it, carried across
    the cuts of the order. A range is one row however wide it is, and a busy address is looked up once.
    """
    distinct = addresses.select(ip).where(F.col(ip).isNotNull()).distinct()
    place = F.struct(*columns)
    starts = ranges.select(
        _end_of(ranges, "ip_from").alias("_at"), F.lit(0).alias("_kind"), F.struct(_end_of(ranges, "ip_to").alias("last"), place.alias("place")).alias("_range"),
        F.lit(None).cast("string").alias("_ip"),
    ).where("_at is not null")
    nowhere = F.lit(None).cast(starts.schema["_range"].dataType)
    asked = distinct.select(address_key(F.col(ip)).alias("_at"), F.lit(1).alias("_kind"), nowhere.alias("_range"), F.col(ip).alias("_ip"))
    found = carried(starts.unionByName(asked), ["_at", "_kind", "_ip"], {"_held": F.when(F.col("_kind") == 0, F.col("_range"))})
    holds = F.col("_at") <= F.col("_held.last")
    return found.where("_kind = 1").select(
        F.col("_ip").alias(ip), *[F.when(holds, F.col(f"_held.place.{x}")).alias(x) for x in columns]
    )


# Spellings repaired before matching, city added to the list, and names that count as cities.
ADDRESS_REPAIRS = [("Thừa Thiên Huế: TP Huế", "Huế"), ("Thừa Thiên Huế", "Huế"), ("TP", "")]
EXTRA_CITY = "Hồ Chí Minh"
CITY_LIKE = ("nuoc ngoai", "toan quoc")


def admin_names(units: DataFrame, district: str, city: str) -> DataFrame:
    """(folded name, kind) of the known cities and districts; a name that is both is a city."""
    extra = literal_rows(units.sparkSession, [(x,) for x in (EXTRA_CITY, *CITY_LIKE)], "name string")
    cities = units.select(F.col(city).alias("name")).unionByName(extra).select("name", F.lit("city").alias("kind"))
    districts = units.select(F.col(district).alias("name"), F.lit("district").alias("kind"))
    folded = cities.unionByName(districts).select(fold_accents(F.col("name")).alias("folded"), "kind")
    return folded.groupBy("folded").agg(F.min("kind").alias("kind"))


def tag_addresses(df: DataFrame, key: str, address: str, names: DataFrame) -> DataFrame:
    """City and district lists per row of ``df``, found by comparing address parts with known names.

    Parts are divided by ':' and ','; case and accents do not matter, matches keep their
    spelling and come out sorted. ``key`` is unique, so a group is one address.
    """
    text = F.col(address)
    for old, new in ADDRESS_REPAIRS:
        text = F.replace(text, F.lit(old), F.lit(new))
    parts = F.flatten(F.transform(F.split(text, ":"), lambda p: F.split(F.trim(p), ",")))
    tokens = df.select(key, F.explode_outer(F.array_distinct(parts)).alias("token"))
    tagged = tokens.join(names, fold_accents(F.col("token")) == F.col("folded"), "left")

    def listed(kind: str) -> Column:
        found = F.collect_set(F.when(F.col("kind") == kind, F.col("token")))
        return F.nullif(F.array_join(F.array_sort(found), ", "), F.lit(""))

    return tagged.groupBy(key).agg(listed("city").alias("city"), listed("district").alias("district"))


def batch_report(
    inputs: DataFrame, outputs: DataFrame, batch: str, key: str, succeeded: Column
) -> DataFrame:
    """Per batch: rows in and out, rows that succeeded, distinct keys in and succeeded out."""
    came = inputs.groupBy(batch).agg(
        F.count("*").alias("inp_rows"), F.count_distinct(key).alias("inp_keys")
    )
    went = outputs.groupBy(batch).agg(
        F.count("*").alias("oup_rows"),
        F.count_if(succeeded).alias("oup_success_rows"),
        F.count_distinct(F.when(succeeded, F.col(key))).alias("oup_keys"),
    )
    both = came.join(went, batch, "full_outer")
    return both.na.fill(0)


def missing_keys(inputs: DataFrame, outputs: DataFrame, batch: str, key: str, succeeded: Column) -> DataFrame:
    """Distinct (batch, key) pairs that went in and never came out with success."""
    done = outputs.where(succeeded).select(batch, key)
    return inputs.select(batch, key).distinct().join(done, [batch, key], "left_anti")
