"""Streams over several files: batches, restarts, repeated keys."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from larkspur.functions.nested import CLICK_SCHEMA
from larkspur.operators import versions
from larkspur.session import new_folder
from larkspur.streaming import events as ev
from larkspur.streaming import reports, sinks, star

RECORD = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"


def files(spark, batches, schema):
    """One file per batch, read oldest first."""
    folder = new_folder(spark, "input")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def record(offset, value):
    return (b"k", None if value is None else value.encode(), "t", 0, offset, None)


def click(**fields):
    return json.dumps({"ip": "1.1.1.1", "user_agent": "curl/7", "time_stamp": 1704067207, **fields})


LINES = [[("a b a",), ("c",)], [("a b",), ("dd dd dd",)]]


def counts_store(spark):
    root = new_folder(spark, "counts")
    versions.create(spark, root, {"counts": "word string, count bigint, _batch bigint"})
    return root


def test_running_and_per_batch_counts_differ(spark, rows):
    folder = files(spark, LINES, "value string")
    root, per, checkpoint = counts_store(spark), new_folder(spark, "per"), new_folder(spark, "c1")
    lines = stream(spark, folder, "value string")
    write = sinks.changes_into(root, "counts", ["word"], checkpoint)
    sinks.finish(
        sinks.start(ev.word_counts(lines, "value"), checkpoint, batch=write, mode="update"),
        sinks.start(lines, new_folder(spark, "c2"), batch=sinks.per_batch(per, lambda d: ev.word_counts(d, "value"))),
    )
    total = sinks.read_changes(spark, root, "counts", ["word"])
    assert rows(total) == [("a", 3), ("b", 2), ("c", 1), ("dd", 3)]
    batches = spark.read.parquet(f"{per}/*").groupBy("batch_id").agg(F.sum("count").alias("n"))
    assert rows(batches) == [(0, 4), (1, 5)]
    assert rows(ev.even_words(total)) == [("b", 2)]
    assert rows(ev.odd_long_words(total)) == [("dd", 3)]
    # the second batch changed a, b and dd, and wrote no more than that
    stored = versions.read(spark, root, "counts").groupBy("_batch").count()
    assert rows(stored) == [(0, 3), (1, 3)]


def test_kept_changes_are_bounded(spark, rows):
    folder = files(spark, [[(f"w{i} same",)] for i in range(7)], "value string")
    root, checkpoint = counts_store(spark), new_folder(spark, "c")
    write = sinks.changes_into(root, "counts", ["word"], checkpoint, folders=3)
    counts = ev.word_counts(stream(spark, folder, "value string"), "value")
    sinks.finish(sinks.start(counts, checkpoint, batch=write, mode="update"))
    assert rows(sinks.read_changes(spark, root, "counts", ["word"])) == [("same", 7)] + [(f"w{i}", 1) for i in range(7)]
    now = versions.current(spark, root)
    assert sum(len(f) for f in now.folders["counts"].values()) <= 4
    kept = spark.read.option("basePath", f"{root}/versions").parquet(f"{root}/versions/version=*").select("version").distinct().count()
    assert kept <= 5
    # a batch that comes again adds nothing
    before = now.number
    write(spark.createDataFrame([("same", 99)], "word string, count bigint"), 6)
    assert versions.current(spark, root).number == before


def test_word_split_keeps_empty_words(spark, rows):
    df = spark.createDataFrame([("a  b",)], "value string")
    assert rows(ev.word_counts(df, "value")) == [("", 1), ("a", 1), ("b", 1)]


BATCHES = [
    [
        record(0, click(id="e1", product_id="7", store_id="first")),
        record(1, click(id="e1", product_id="7", store_id="later", time_stamp=1704067300)),
        record(2, click(id="e2", ip=None)),
        record(3, None),
    ],
    [
        record(4, click(id="e1", product_id="7", store_id="second batch")),
        record(5, click(product_id="8")),
        record(6, '{"id": "e9", "ip'),
        record(7, click(id="e3", product_id="7", user_agent=None)),
    ],
]


def load(spark, folder, root, checkpoint):
    sinks.finish(sinks.start(stream(spark, folder, RECORD), checkpoint, batch=star.batch_loader(root, ev.enrich)))


def table(spark, root, name, *columns):
    return sorted((tuple(r) for r in star.star_table(spark, root, name).select(*columns).collect()), key=repr)


def test_star_load(spark):
    folder, root = files(spark, BATCHES, RECORD), new_folder(spark, "star")
    star.create_star(spark, root)
    load(spark, folder, root, new_folder(spark, "c"))

    def everything():
        return {name: table(spark, root, name, *columns) for name, columns in star.TABLES.items()}

    once = everything()
    # the first row per key wins within a batch and across batches; unreadable and keyless rows are left out
    assert table(spark, root, "fact_sales", "store_id", "full_time") == [("first", "00:00:07"), (None, "00:00:07"), (None, "00:00:07")]
    assert table(spark, root, "dim_product", "product_key", "name") == [("7", None), ("8", None)]
    assert table(spark, root, "dim_location", "ip_address", "city_name") == [("1.1.1.1", None)]
    assert table(spark, root, "dim_user_agent", "browser", "os") == [("Other", "Other")]
    # a replay of the whole stream changes nothing
    load(spark, folder, root, new_folder(spark, "c"))
    assert everything() == once


def test_stream_equals_batch(spark, rows):
    folder, out = files(spark, BATCHES, RECORD), new_folder(spark, "enriched")
    sinks.finish(sinks.start(ev.enrich(stream(spark, folder, RECORD)), new_folder(spark, "c"), "parquet", out))
    assert rows(spark.read.parquet(out)) == rows(ev.enrich(spark.read.schema(RECORD).parquet(folder)))


def test_restart_takes_only_new_files(spark):
    folder, out, checkpoint = files(spark, BATCHES[:1], RECORD), new_folder(spark, "o"), new_folder(spark, "c")

    def run(target, point):
        sinks.finish(sinks.start(ev.relay(stream(spark, folder, RECORD)), point, "parquet", target))
        return spark.read.parquet(target).count()

    assert run(out, checkpoint) == 3
    spark.createDataFrame(BATCHES[1], RECORD).coalesce(1).write.mode("append").parquet(folder)
    assert run(out, checkpoint) == 7
    assert run(new_folder(spark, "o"), new_folder(spark, "c")) == 7


def test_documents_and_dead_letters(spark, rows):
    df = spark.createDataFrame(BATCHES[0] + BATCHES[1] + [record(8, "[1]")], RECORD)
    assert [r["_kafka_offset"] for r in ev.documents(df).orderBy("_kafka_offset").collect()] == [0, 1, 2, 4, 5, 7]
    assert rows(ev.dead_letters(df).select("offset")) == [(6,), (8,)]


def test_a_load_from_tasks_is_idempotent(spark):
    df = spark.createDataFrame(BATCHES[0] + BATCHES[1], RECORD)
    root = new_folder(spark, "star")
    star.create_star(spark, root)
    load = star.batch_loader(root, ev.enrich, writers=3)
    sizes = []
    for _ in range(2):
        load(df, 0)
        sizes.append([star.star_table(spark, root, name).count() for name in star.TABLES])
    files = star.star_table(spark, root, "fact_sales").select("_metadata.file_name").distinct().count()
    assert sizes[0] == sizes[1] and sizes[0][-1] > 0 and files <= 3


def test_a_large_batch_is_written_in_slices(spark, monkeypatch):
    """Two writers with one row each at a time: more than one write, and the rows that one write gives."""
    clicks = [record(n, click(id=f"e{n % 7}", product_id=str(n % 5), ip=f"1.1.1.{n % 3}", time_stamp=1704067207 + 40000 * n)) for n in range(14)]
    df = spark.createDataFrame(clicks + BATCHES[0], RECORD)

    def loaded(writers):
        root = new_folder(spark, "star")
        star.create_star(spark, root)
        load = star.batch_loader(root, ev.enrich, writers)
        for n in range(2):
            load(df, n)
        return {name: table(spark, root, name, *columns) for name, columns in star.TABLES.items()}

    whole = loaded(None)
    monkeypatch.setattr(star, "SMALL_BATCH", 10)
    monkeypatch.setattr(star, "ROWS_PER_WRITER", 1)
    writes = []
    one = versions.Change.append

    def append(change, name, *slices):
        if name == "fact_sales":
            writes.append([(s.rdd.getNumPartitions(), s.count()) for s in slices])
        return one(change, name, *slices)

    monkeypatch.setattr(versions.Change, "append", append)
    assert loaded(2) == whole and len(whole["fact_sales"]) > 10
    first, second = writes
    assert {partitions for partitions, _ in first} == {2} and max(n for _, n in first) <= 2 and second == []
    assert sum(n for _, n in first) == len(whole["fact_sales"])


def test_every_batch_is_counted(spark):
    folder, path = files(spark, BATCHES, RECORD), new_folder(spark, "kept")
    checkpoint = new_folder(spark, "c")
    watch = sinks.counted(path, {"n": F.count("value")})
    sinks.finish(sinks.start(stream(spark, folder, RECORD), checkpoint, batch=watch))
    got = sinks.read_counted(spark, path, "n").orderBy("batch_id").collect()
    assert [(r["input_rows"], r["n"]) for r in got] == [(4, 3), (4, 4)]


def test_a_failure_of_any_query_is_raised(spark):
    folder = files(spark, BATCHES, RECORD)

    def fail(_rows, _batch_id):
        raise ValueError("broken sink")

    endless = sinks.start(stream(spark, folder, RECORD), new_folder(spark, "c"), "noop", interval="1 second")
    broken = sinks.start(stream(spark, folder, RECORD), new_folder(spark, "c"), batch=fail)
    try:
        with pytest.raises(StreamingQueryException):
            sinks.finish(endless, broken)
    finally:
        endless.stop()


def test_progress_and_intake(spark):
    folder = files(spark, BATCHES, RECORD)
    watched = stream(spark, folder, RECORD).observe("seen", F.count("value").alias("n"))
    query = sinks.start(watched, new_folder(spark, "c"), "noop")
    sinks.finish(query)
    got = sinks.progress(spark, query).orderBy("batch_id").collect()
    assert [(r["input_rows"], r["observed"]["seen.n"]) for r in got] == [(4, "3"), (4, "4")]


def test_layouts():
    assert len(star.FACT_SALES) == 20 and star.primary_key("dim_date") == ["full_date"]
    assert star.primary_key("fact_sales") == ["sales_key"] and star.primary_key("other") == ["id"]
    assert "sales_key" not in CLICK_SCHEMA.fieldNames()


HOUR = 3600
NOON = 1704110400


def seen(offset, at, **fields):
    return record(offset, click(id=f"e{offset}", time_stamp=at, current_url="https://www.shop.de/p", **fields))


def test_running_reports_with_late_events(spark):
    """An event within the delay counts in its hour, one that is later does not; hours leave the state."""
    batches = [
        [seen(0, NOON, product_id="1"), seen(1, NOON + 60, product_id="2"), record(2, None), record(3, '{"id": "x')],
        [seen(4, NOON + 3 * HOUR, product_id="1")],
        [seen(5, NOON + 2 * HOUR, product_id="1"), seen(6, NOON - 9 * HOUR, product_id="1")],  # late, and too late
        [seen(7, NOON + 9 * HOUR, product_id="2")],
        [seen(8, NOON + 9 * HOUR + 5, product_id="2")],
    ]
    folder, root = files(spark, batches, RECORD), new_folder(spark, "views")
    reports.create(spark, root)
    query = reports.keep_counts(stream(spark, folder, RECORD), root, new_folder(spark, "c"), "2 hours")
    sinks.finish(query)
    kept = {(r["first"], r["hour"]): r["views"] for r in reports.counts_of(spark, root, "product", "2024-01-01").collect()}
    assert kept == {("1", "12"): 1, ("2", "12"): 1, ("1", "15"): 1, ("1", "14"): 1, ("2", "21"): 2}
    # the batch report over the same events, without the one that came too late
    whole = reports.page_views(spark.read.schema(RECORD).parquet(folder).where("offset <> 6"))
    batch = {(r["product_id"], r["hour"]): r["count"] for r in whole.where("product_id is not null").groupBy("product_id", "hour").count().collect()}
    assert batch == kept
    assert [tuple(r) for r in reports.top(spark, root, "product", "2024-01-01", 1).collect()] == [("1", 3)]
    sizes = [(p.stateOperators[0].numRowsTotal, p.stateOperators[0].numRowsRemoved) for p in query.recentProgress if p.stateOperators]
    assert max(total for total, _ in sizes) > sizes[-1][0] and sum(removed for _, removed in sizes) > 0


def test_progress_is_kept_from_outside(spark):
    """More than a hundred batches of a plain file sink, and a query that fails."""
    folder = files(spark, [[record(0, "x")]], RECORD)
    many = new_folder(spark, "many")
    spark.range(120).repartition(120).write.option("maxRecordsPerFile", 1).parquet(many)
    log = sinks.ProgressLog(spark, new_folder(spark, "log"))
    spark.streams.addListener(log)
    try:
        plain = sinks.start(stream(spark, many, "id bigint"), new_folder(spark, "c"), "parquet", new_folder(spark, "out"))
        sinks.finish(plain)
        broken = sinks.start(stream(spark, folder, RECORD).select(F.raise_error(F.lit("no way")).cast("int").alias("x")), new_folder(spark, "c"), "noop")
        with pytest.raises(StreamingQueryException):
            sinks.finish(broken)
        log.wait(plain)
        log.wait(broken)
    finally:
        spark.streams.removeListener(log)
    kept = log.rows().where((F.col("run") == str(plain.runId)) & (F.col("event") == "batch"))
    assert kept.where("input_rows > 0").count() > 100 and kept.agg(F.sum("input_rows")).first()[0] == 120
    end = log.rows().where((F.col("run") == str(broken.runId)) & (F.col("event") == "end")).first()
    assert "no way" in end["error"]
    assert log.rows().where((F.col("run") == str(plain.runId)) & (F.col("event") == "end")).first()["error"] is None
