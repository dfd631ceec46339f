"""Loading micro-batches into the star schema."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators import versions
from larkspur.operators.mutation import insert_if_absent, one_per_key
from larkspur.session import new_folder, remove_folder, spread

SMALL_BATCH = 100_000  # rows whose keys may go to all tasks
ROWS_PER_TASK = 100_000  # a message grows when it is parsed
ROWS_PER_WRITER = 500_000  # of a limited number of writers, at a time

# Fixed layout of the star schema: columns in table order, and the primary key first.
FACT_SALES = [
    "sales_key", "full_date", "full_time", "ip_key", "user_agent_key", "product_key", "referrer_url", "collection", "option",
    "email_address", "resolution", "user_id_db", "device_id", "api_version", "store_id", "local_time", "show_recommendation",
    "recommendation", "utm_source", "utm_medium",
]
DIM_PRODUCT = ["product_key", "name", "current_url", "language_code"]
DIM_LOCATION = ["ip_key", "ip_address", "country_code", "country_name", "region_name", "city_name"]
DIM_USER_AGENT = ["user_agent_key", "user_agent", "browser", "os"]
TABLES = {
    "dim_product": DIM_PRODUCT,
    "dim_location": DIM_LOCATION,
    "dim_user_agent": DIM_USER_AGENT,
    "fact_sales": FACT_SALES,
}


def primary_key(table: str) -> list[str]:
    """The key columns of a star table; a table that is not part of the star has 'id'."""
    return {**{name: columns[:1] for name, columns in TABLES.items()}, "dim_date": ["full_date"]}.get(table, ["id"])


def create_star(spark: SparkSession, root: str) -> None:
    """Empty tables in a store at ``root``; one that exists is left alone. The fact is cut by day."""
    schemas = {name: T.StructType([T.StructField(x, T.StringType()) for x in columns]) for name, columns in TABLES.items()}
    versions.create(spark, root, schemas, {"fact_sales": "full_date"})


def star_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table as the last committed batch left it."""
    return versions.read(spark, root, name)


# What a batch of events brings to each table. Rows may repeat: the insert keeps one per key,
# so making them distinct here would only shuffle them once more.


def product_rows(events: DataFrame) -> DataFrame:
    """Placeholder rows for the products seen; their texts are filled in by other loads."""
    empty = [F.lit(None).cast("string").alias(x) for x in DIM_PRODUCT[1:]]
    return events.select("product_key").na.drop().select("product_key", *empty)


def location_rows(events: DataFrame) -> DataFrame:
    empty = [F.lit(None).cast("string").alias(x) for x in DIM_LOCATION[2:]]
    return events.select("ip_key", F.col("ip").alias("ip_address")).na.drop().select("*", *empty)


def user_agent_rows(events: DataFrame) -> DataFrame:
    return events.select(*DIM_USER_AGENT).na.drop()


def fact_rows(events: DataFrame) -> DataFrame:
    return events.na.drop(subset=["sales_key"]).select(*FACT_SALES)


LOADS: dict[str, tuple[Callable[[DataFrame], DataFrame], tuple[str, ...]]] = {
    "dim_product": (product_rows, ()),
    "dim_location": (location_rows, ()),
    "dim_user_agent": (user_agent_rows, ()),
    "fact_sales": (fact_rows, ("full_date", "full_time")),
}


def days_near(days: Iterable[str], back: int) -> list[str]:
    """Days as text and so many days on either side of each; what is no day stays alone."""
    out = []
    for day in days:
        try:
            middle = datetime.date.fromisoformat(day)
        except ValueError:
            out.append(day)
        else:
            out += [str(middle + datetime.timedelta(n)) for n in range(-back, back + 1)]
    return list(dict.fromkeys(out))


def stored_rows(change: versions.Change, name: str, rows: DataFrame, days_back: int | None) -> DataFrame | None:
    """The stored rows that can have a key of the batch; none if the table is empty.

    Of the fact these are the days of the batch and ``days_back`` on either side: a sale that is sent again has the
    day it had, give or take a clock. Without a bound all days are looked through.
    """
    parts = None
    if change.part_columns[name] is not None and days_back is not None:
        parts = days_near(change.parts_of(name, rows), days_back)
    folders = change.folders[name]
    if not any(folders.get(p) for p in (folders if parts is None else parts)):
        return None
    return change.table(name, parts)


def slices(spark: SparkSession, folder: str, schema: T.StructType, writers: int, keys: list[str]) -> list[DataFrame]:
    """The rows of a folder in slices, none with more rows than so many writers take at a time.

    A slice is some whole files, none larger than what one writer takes; their names and counts go to the driver.
    """
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    read = spark.read.schema(schema)
    groups: list[list[str]] = []
    room = 0
    for file, n in read.parquet(folder).groupBy(name.alias("file")).count().collect():
        if n > room or not groups:
            groups.append([])
            room = writers * ROWS_PER_WRITER
        groups[-1].append(f"{folder}/{file}")
        room -= n
    return [read.parquet(*files).repartition(writers, *keys) for files in groups]


def load_star(
    events: DataFrame, root: str, writers: int | None = None, source: str | None = None, batch: int = 0, days_back: int | None = None, folders: int = 8
) -> dict[str, int]:
    """Add what is new in a batch of enriched events to the four tables, in one commit; returns the rows added.

    A key that the table already has, or that an earlier row of the batch brought, is not added again, so loading a
    batch twice changes nothing; with a ``source`` a batch number that is already committed is not even looked at. A crash
    before the commit leaves all four tables as they were. With ``writers`` each table is written by that many tasks at a
    time, for stores that allow so many connections; a large batch is written by them in slices, so no task holds a
    fixed share of it. A day with more than so many ``folders`` is written as one.
    """
    spark = events.sparkSession
    change = versions.Change(spark, root)
    if source is not None and not change.apply_once(source, batch):
        return dict.fromkeys(LOADS, 0)
    small = events.count() <= SMALL_BATCH

    def add(name: str) -> int:
        rows, order = LOADS[name]
        first: list[Column] = [F.col(x) for x in order]
        coming, key = rows(events), primary_key(name)
        stored = stored_rows(change, name, coming, days_back)
        if stored is None:
            new = one_per_key(coming.na.drop(subset=key), key, *first)
        else:
            new = insert_if_absent(coming, stored, key, *first, small=small)
        if not writers:
            return change.append(name, new)
        if small:
            return change.append(name, new.repartition(writers, *key))
        folder = new_folder(spark, "new")
        new.write.option("maxRecordsPerFile", ROWS_PER_WRITER).parquet(folder)
        added = change.append(name, *slices(spark, folder, new.schema, writers, key))
        remove_folder(spark, folder)
        return added

    # the tables are written side by side; nothing shows before the commit
    with ThreadPoolExecutor(len(LOADS)) as pool:
        added = dict(zip(LOADS, pool.map(add, LOADS)))
    for name in LOADS:
        change.compact(name, folders)
    change.commit()
    return added


def batch_loader(
    root: str, transform: Callable[[DataFrame], DataFrame], writers: int | None = None, source: str | None = None, days_back: int | None = None
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: transforms a batch of records and loads the star tables.

    Empty batches are skipped. A batch from a topic of few partitions is spread over all
    cores before the transform, and is transformed once for all four tables. ``source`` names the stream, best by its
    checkpoint: its batches then count once, whatever happens between the commit of the star and that of the stream.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        held = transform(spread(batch, ROWS_PER_TASK)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            load_star(held, root, writers, source, batch_id, days_back)
        finally:
            held.unpersist()

    return load
