"""Session builder, driver-table loader and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "larkspur", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator assumes.

    UTC keeps day boundaries equal between batch, stream and SQL checks. Adaptive
    execution picks broadcast joins from measured sizes, splits skewed join
    partitions and merges small shuffle partitions, so no join here carries a broadcast hint.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, most: int | None = None) -> DataFrame:
    """Hand a scan of few files to all cores, for work that is heavy per row.

    A scan that already has about as many partitions as the cluster has cores is returned
    as it is, so large tables are not shuffled here. A partition, at most 128 MB by
    default, is cut into no more than 32 pieces.

    ``most`` is for rows that become much larger than they are stored, such as documents made of
    few numbers: a task then gets about that many rows, however many cores there are. The rows are counted
    for it, which for a table reads no more than the footers of its files.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    pieces = -(-df.count() // most) if most else 0
    if pieces > 1:
        return df.repartition(max(pieces, cores), *df.columns)
    partitions = df.rdd.getNumPartitions()
    if partitions * 2 > cores:
        return df
    # by value and not in turn: the latter sorts every partition first to be repeatable
    return df.repartition(min(cores, max(1, partitions) * 32), *df.columns)


def stream_table(spark: SparkSession, sf_dir: str, name: str, **options: str) -> DataFrame:
    """The same table as a file stream.

    The path is written as a glob because the file source only takes a base
    path that is a folder, and the given tables may be single files.
    """
    schema = table(spark, sf_dir, name).schema
    path = f"{sf_dir}/{name}.parque[t]"
    return spark.readStream.schema(schema).options(**options).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    A local session without the setting gets a temporary folder; a cluster
    session without it is refused, since executors cannot share one.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


class Written(NamedTuple):
    """A frame that reads what was written, and the folder it lies in."""

    frame: DataFrame
    folder: str


def written(spark: SparkSession, df: DataFrame, label: str = "cut") -> Written:
    """Write a frame to the shared folder; for steps whose folder is removed once nothing reads it any more."""
    folder = new_folder(spark, label)
    df.write.parquet(folder)
    return Written(spark.read.schema(df.schema).parquet(folder), folder)


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query are removed as soon as it ends.

    For a row of written steps: what a step has shuffled is of no use once its result is written, and would
    otherwise stay on the executors' disks until the driver happens to collect garbage. While a query runs, its files are
    there for retries as ever; a frame that is run twice shuffles twice.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def cut_lineage(spark: SparkSession, df: DataFrame, label: str = "cut") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Later stages read the files, so a lost executor costs a re-read and not the
    whole upstream plan.
    """
    return written(spark, df, label).frame
