"""File and table writers."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators.mutation import one_per_key, replace_table
from larkspur.session import cut_lineage, new_folder
from larkspur.sources.literal import literal_rows
from larkspur.sources.readers import read_csv, read_files


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", rows_per_file: int = 0) -> None:
    """CSV with a header. Quotes are doubled and blanks survive; an empty text reads back as NULL."""
    df.write.mode(mode).options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        maxRecordsPerFile=rows_per_file,
    ).csv(path)


def write_partitioned(
    df: DataFrame, path: str, columns: Sequence[str], fmt: str = "json", rows_per_file: int = 10_000, mode: str = "overwrite"
) -> None:
    """One folder per combination of the columns, at most ``rows_per_file`` rows in a file."""
    df.write.format(fmt).mode(mode).partitionBy(*columns).option("maxRecordsPerFile", rows_per_file).save(path)


def write_repartitioned(df: DataFrame, path: str, partitions: int, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Spread the rows over a given number of partitions, then write."""
    df.repartition(partitions).write.format(fmt).mode(mode).save(path)


def write_batches(
    df: DataFrame, path: str, rows_per_file: int, fmt: str = "parquet", mode: str = "errorifexists", rows_per_task: int = 500_000
) -> int:
    """Files of exactly ``rows_per_file`` rows, but for one with the rest; returns the number of files.

    The rows are written once to know how many each file has; sums over the files number all rows, and a batch is
    a number's quotient. Batches are dealt out whole and in order, so the writer's limit falls on their edges. A task
    writes as many batches as ``rows_per_task`` holds, for each task sends its figures to the driver.
    """
    rows = cut_lineage(df.sparkSession, df, "batches")
    place = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = place.groupBy("_file").agg(F.count("*").alias("_n"))
    # one row per file
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    numbered = place.join(offsets, "_file").withColumn("_place", F.col("_before") + F.col("_row"))
    batches = -(-(sizes.agg(F.sum("_n")).first()[0] or 0) // rows_per_file)
    batch = F.floor(F.col("_place") / rows_per_file)
    tasks = -(-batches // max(1, rows_per_task // rows_per_file))
    dealt = numbered.withColumn("_batch", batch).repartitionByRange(max(1, tasks), "_batch").sortWithinPartitions("_place")
    dealt.select(*df.columns).write.format(fmt).mode(mode).option("maxRecordsPerFile", rows_per_file).save(path)
    return batches


def write_jdbc(df: DataFrame, url: str, name: str, properties: Mapping[str, str], mode: str = "append", batch: int = 10_000) -> None:
    """Insert into a database table, in bulk statements of ``batch`` rows."""
    df.write.format("jdbc").options(**properties, url=url, dbtable=name, batchsize=str(batch)).mode(mode).save()


def save_table(df: DataFrame, name: str, if_exists: str = "fail") -> int:
    """Write a catalog table; returns the rows written, counted on the way.

    ``if_exists`` is 'fail', 'replace' or 'append'.
    """
    counted = Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    if if_exists == "replace":
        replace_table(rows, name)
    elif if_exists == "append":
        rows.write.mode("append").saveAsTable(name)
    else:
        path = new_folder(df.sparkSession, name)
        rows.write.mode("errorifexists").option("path", path).saveAsTable(name)
    return counted.get["rows"]


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types; text that does not fit becomes NULL."""
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def csv_headers(spark: SparkSession, source: str) -> dict[str, list[str]]:
    """The files of each header line; there are few different ones."""
    lines = spark.read.text(source).select(
        "value", F.col("_metadata.file_path").alias("file"), F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place")
    )
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    return {r["header"]: r["files"] for r in first.groupBy("header").agg(F.collect_list("file").alias("files")).collect()}


def convert_csv(spark: SparkSession, source: str, target: str, schema: T.StructType, fmt: str = "parquet") -> None:
    """CSV files to another format under a target schema, each read by its own header.

    Headers may differ in order and in columns; columns that a file lacks become NULL, others are left out.
    """
    parts = []
    for header, files in csv_headers(spark, source).items():
        names = next(csv.reader([header]), [])
        texts = T.StructType([T.StructField(name, T.StringType()) for name in names])
        parts.append(cast_to(read_csv(spark, files, texts), schema))
    rows = reduce(DataFrame.unionByName, parts) if parts else literal_rows(spark, [], schema)
    rows.write.format(fmt).mode("overwrite").save(target)


def load_folders(spark: SparkSession, root: str, tables: Mapping[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """Each folder's files become the whole content of its table."""
    return {
        folder: replace_table(read_files(spark, fmt, f"{root}/{folder}/*"), name) for folder, name in tables.items()
    }


def ingest_csv_files(
    spark: SparkSession, pattern: str, schema: T.StructType, names: Mapping[str, str], key: str
) -> DataFrame:
    """All files that match: chosen columns renamed, the key as text, one row per key.

    Among rows with the same key the smallest by the other columns stays, whatever the file order.
    """
    rows = read_csv(spark, pattern, schema).select(*[F.col(old).alias(new) for old, new in names.items()])
    return one_per_key(rows.withColumn(key, F.col(key).cast("string")).na.drop(subset=[key]), [key])


def unprocessed(df: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of the files that the manifest (one column ``path``) does not list."""
    return df.withColumn("path", F.col("_metadata.file_path")).join(manifest, "path", "left_anti")


def store_blobs(files: DataFrame, key_pattern: str, folders: int = 0) -> DataFrame:
    """Rows of a binaryFile scan as (id, extension, data); the id is found in the file name and so many folders before it."""
    name = F.element_at(F.split("path", "/"), -1)
    told = F.substring_index("path", "/", -1 - folders)
    return files.select(
        F.regexp_extract(told, key_pattern, 1).alias("id"),
        F.substring_index(name, ".", -1).alias("file_extension"),
        F.col("content").alias("drawing_data"),
    )
