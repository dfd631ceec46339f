"""Sales warehouse: staging frames, dimensions, fact and flat mart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions import dates, keys, money
from larkspur.operators.aggregates import weighted_average
from larkspur.operators.mutation import one_per_key
from larkspur.operators.relational import sentinels_to_null, with_unknown_member

Key = Callable[..., Column]

# States of a crawl that count as success.
GOOD_STATUS = ("200", "playwright_success")
LOCATION_TEXTS = ("country_short_name", "country_long_name", "region_name", "city_name")


def stage_locations(source: DataFrame, key: Key = keys.fingerprint) -> DataFrame:
    """Distinct located addresses with a key; '-' marks a missing value, and a missing country drops the row."""
    named = (
        source.distinct()
        .where((F.col("country_long") != "-") & (F.col("ip") != "-"))
        .select(
            key(F.col("ip")).alias("location_key"),
            F.col("ip").alias("ip_address"),
            F.col("country_short").alias("country_short_name"),
            F.col("country_long").alias("country_long_name"),
            F.col("region").alias("region_name"),
            F.col("city").alias("city_name"),
        )
    )
    return sentinels_to_null(named, ["region_name", "city_name"], ["-"])


def stage_products(source: DataFrame) -> DataFrame:
    """The first row by name of every product, kept only if that row's crawl succeeded."""
    columns = source.select("product_id", "name", "status_code")
    first = one_per_key(columns, ["product_id"], F.col("name"), F.col("status_code"))
    return first.where(F.col("status_code").isin(*GOOD_STATUS)).select(
        F.col("product_id").cast("int").alias("product_key"), F.col("name").alias("product_name")
    )


def stage_sales(source: DataFrame, rates: DataFrame, key: Key = keys.fingerprint) -> DataFrame:
    """One row per sale and product: prices read, converted to dollars and weighted by amount.

    Currencies without a rate drop their rows. An unreadable price is left out of the
    weighted sum, while its amount still counts.
    """
    items = (
        source.where(F.col("collection") == "checkout_success")
        .select("_id", "ip", "time_stamp", F.explode("cart_products").alias("cp"))
        .select("_id", "ip", "time_stamp", "cp.*")
        .where("product_id is not null and price is not null and currency is not null and currency != '' and amount is not null")
    )
    priced = items.select(
        key(F.col("_id"), F.col("product_id")).alias("sales_key"),
        F.col("product_id").alias("product_key"),
        key(F.col("ip")).alias("location_key"),
        F.to_date(F.timestamp_seconds("time_stamp")).alias("full_date"),
        F.col("_id").alias("order_key"),
        money.locale_price(F.col("price")).alias("local_price"),
        "currency",
        "amount",
    )
    converted = priced.join(rates.select("symbol", "exchange_rate"), F.col("symbol") == F.col("currency")).withColumn(
        "price", F.col("local_price") * F.col("exchange_rate")
    )
    return converted.groupBy("sales_key", "product_key", "location_key", "full_date", "order_key").agg(
        weighted_average("price", "amount").alias("price"), F.sum("amount").alias("amount")
    )


def dim_location(staged: DataFrame, unknown_key=-1) -> DataFrame:
    filled = staged.na.fill("XNA", list(LOCATION_TEXTS)).distinct()
    return with_unknown_member(filled, "location_key", unknown_key)


def dim_product(staged: DataFrame) -> DataFrame:
    return with_unknown_member(staged.distinct(), "product_key", -1)


def dim_date(spark, first: str = "2015-01-01", last: str = "2025-12-31") -> DataFrame:
    return dates.sunday_week_attributes(dates.calendar_span(spark, first, last))


def dim_date_of(df: DataFrame, day: str) -> DataFrame:
    """The calendar from the first to the last day in use; empty if there is none."""
    first, last = df.agg(F.min(day).cast("string"), F.max(day).cast("string")).first()
    return dim_date(df.sparkSession, first, last)


def fact_sales(staged: DataFrame) -> DataFrame:
    return staged.withColumn("revenue", F.col("price") * F.col("amount"))


def sales_flat(fact: DataFrame, locations: DataFrame, products: DataFrame, days: DataFrame) -> DataFrame:
    """The fact with all dimension texts; an unknown product is named XNA."""
    named = products.select("product_key", "product_name")
    return (
        fact.join(locations, "location_key", "left")
        .join(named, "product_key", "left")
        .join(days, "full_date", "left")
        .withColumn("product_name", F.coalesce("product_name", F.lit("XNA")))
    )


def first_success(attempts: DataFrame, entity: str, methods: list[str]) -> DataFrame:
    """Per entity the first attempt that gave a name: by method order, then by url; unlisted methods come last.

    An entity without success gets one row that says so, with its first url.
    """
    place = F.array_position(F.lit(methods), F.col("method"))
    rank = F.when(place > 0, place).otherwise(len(methods) + 1)
    good = attempts.where(F.col("name") != "fail").withColumn("_rank", rank)
    chosen = one_per_key(good, [entity], F.col("_rank"), F.col("url")).drop("_rank")
    lost = attempts.join(chosen.select(entity), entity, "left_anti").groupBy(entity).agg(F.min("url").alias("url"))
    failed = lost.select(
        *[
            F.lit({"name": "fail", "language_code": "fail", "status_code": "total_fail", "method": "none"}[x]).alias(x)
            if x not in (entity, "url")
            else F.col(x)
            for x in chosen.columns
        ]
    )
    return chosen.unionByName(failed)
