"""Starting streams, and sinks that leave tables behind."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from larkspur.operators import versions
from larkspur.sources.literal import literal_rows


def start(
    df: DataFrame,
    checkpoint: str,
    fmt: str | None = None,
    path: str | None = None,
    batch: Callable[[DataFrame, int], None] | None = None,
    mode: str = "append",
    interval: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Start a stream into files, the console, a topic or a batch function.

    Without an interval the stream takes what is there and stops. The checkpoint decides
    where it goes on: the same folder resumes, a new one replays from the start.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).options(**options)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    if batch is not None:
        return writer.foreachBatch(batch).start()
    writer = writer.format(fmt)
    return writer.start(path) if path else writer.start()


def finish(*queries: StreamingQuery) -> None:
    """Wait for all; the first failure is raised, whichever query it comes from."""
    running = list(queries)
    while len(running) > 1:
        running = [query for query in running if not query.awaitTermination(1)]
    for query in running:
        query.awaitTermination()


def changes_into(root: str, name: str, keys: Sequence[str], source: str, folders: int = 8) -> Callable[[DataFrame, int], None]:
    """A batch function for update mode: every batch adds its changed rows to a table of the store at ``root``.

    So the bytes of a batch follow its changes and not the whole result. With more than so many folders the table is
    written as one with the last row of each key, and older versions are removed: what is kept is bounded by the result and
    that many batches. A batch that runs again after a crash is not added twice. The table has a column ``_batch``.
    """

    def write(changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        change = versions.Change(spark, root)
        if not change.apply_once(source, batch_id):
            return
        change.append(name, changed.withColumn("_batch", F.lit(batch_id)))
        many = any(len(f) > folders for f in change.folders[name].values())
        if many:
            change.replace(name, _last_rows(change.table(name), keys))
        change.commit()
        if many:
            versions.expire(spark, root, keep=1)

    return write


def _last_rows(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [x for x in changes.columns if x not in keys]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_last"))
    return last.select(*keys, *[f"_last.{x}" for x in rest])


def read_changes(spark: SparkSession, root: str, name: str, keys: Sequence[str]) -> DataFrame:
    """The last row of each key, as of the last committed batch."""
    return _last_rows(versions.read(spark, root, name), keys).drop("_batch")


def per_batch(path: str, transform: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A batch function that treats every batch on its own: nothing is carried over."""

    def write(rows: DataFrame, batch_id: int) -> None:
        transform(rows).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/b{batch_id:06d}")

    return write


PROGRESS = "batch_id bigint, duration_ms bigint, input_rows bigint"


def counted(
    path: str, counts: Mapping[str, Column] | None = None, write: Callable[[DataFrame, int], None] | None = None
) -> Callable[[DataFrame, int], None]:
    """A batch function that keeps a row for every batch: its number, duration, input rows, and the given counts.

    The counts are taken on the way through ``write``, which has to use the whole batch; without it the batch
    is only read. A batch that runs again replaces its row.
    """
    counts = dict(counts or {})

    def run(rows: DataFrame, batch_id: int) -> None:
        seen = Observation()
        watched = rows.observe(seen, F.count(F.lit(1)).alias("input_rows"), *[v.alias(k) for k, v in counts.items()])
        start = time.monotonic()
        if write:
            write(watched, batch_id)
        else:
            watched.write.format("noop").mode("overwrite").save()
        row = [batch_id, round(1000 * (time.monotonic() - start)), *[seen.get[k] for k in ("input_rows", *counts)]]
        schema = PROGRESS + "".join(f", {k} bigint" for k in counts)
        literal_rows(rows.sparkSession, [row], schema).write.mode("overwrite").parquet(f"{path}/batch-{batch_id:06d}")

    return run


def read_counted(spark: SparkSession, path: str, *counts: str) -> DataFrame:
    """What ``counted`` has kept, for all batches."""
    return spark.read.schema(PROGRESS + "".join(f", {k} bigint" for k in counts)).parquet(f"{path}/batch-*")


def progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row for each of the last hundred batches: its number, input rows, duration, and what ``observe`` counted."""
    rows = [
        (
            p["batchId"],
            p["numInputRows"],
            p["durationMs"].get("triggerExecution", 0),
            {f"{name}.{k}": str(v) for name, row in p.get("observedMetrics", {}).items() for k, v in row.asDict().items()},
        )
        for p in query.recentProgress
    ]
    schema = "batch_id bigint, input_rows bigint, duration_ms bigint, observed map<string,string>"
    return literal_rows(spark, rows, T.DataType.fromDDL(schema))


LOG = "run string, name string, event string, batch_id bigint, input_rows bigint, duration_ms bigint, state_rows bigint, error string"


class ProgressLog(StreamingQueryListener):
    """Keeps a row for every batch of every query of a session, and one for its end, whatever its sink.

    The rows are those of Spark's own progress events, written as they come, so they outlast the query and its last
    hundred batches. ``error`` is the message of a query that failed.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def _keep(self, *row) -> None:
        literal_rows(self.spark, [row], LOG).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = sum(s.numRowsTotal for s in p.stateOperators)
        self._keep(str(p.runId), p.name, "batch", p.batchId, p.numInputRows, p.durationMs.get("triggerExecution", 0), state, None)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._keep(str(event.runId), None, "end", None, None, None, None, event.exception)
        self._end_of(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all events of a query that has ended are kept: they arrive a little later."""
        if not self._end_of(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no end of query {query.runId} within {seconds} seconds")

    def rows(self) -> DataFrame:
        return self.spark.read.schema(LOG).parquet(self.path)
