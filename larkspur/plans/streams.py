"""Streaming queries. Each runs a stream over the whole events or documents table until it is used up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators import versions
from larkspur.plans import standins as s
from larkspur.plans.clicks import messages
from larkspur.plans.registry import Tables, query
from larkspur.session import new_folder, spread, stream_table
from larkspur.streaming import events as ev
from larkspur.streaming import reports, sinks, star

c = F.col

READ = ("clicks", "parsed")


def record_stream(t: Tables):
    """Broker records as a stream; files stand in for the broker."""
    return messages(t, stream_table(t.spark, t.sf_dir, "events"))


def _to_files(t: Tables, df, label: str, **options):
    """Run a stream into parquet files and read them back."""
    out, checkpoint = new_folder(t.spark, label), new_folder(t.spark, f"{label}-checkpoint")
    sinks.finish(sinks.start(df, checkpoint, "parquet", out, **options))
    return t.spark.read.schema(df.schema).parquet(out)


@query(
    "x01_stream_source",
    s.with_("clicks")
    + """select "offset", topic, "partition", key, value_length from (select event_id as "offset", 'product_view' as topic,
         cast(user_id % 3 as integer) as "partition", cast(user_id as varchar) as key, shape <> 'null' as value_length from clicks)""",
)
def x01(t: Tables):
    records = _to_files(t, record_stream(t), "records")
    return records.select(
        "offset", "topic", "partition", c("key").cast("string").alias("key"), c("value").isNotNull().alias("value_length")
    )


@query(
    "x02_bytes_to_text",
    s.with_("clicks") + """select event_id as "offset", cast(user_id as varchar) as key, shape = 'ok' as complete from clicks where shape <> 'null'""",
)
def x02(t: Tables):
    text = ev.as_text(ev.present(record_stream(t))).select("offset", "key", c("value").endswith("}").alias("complete"))
    return _to_files(t, text, "text")


_WORDS_SQL = "select word, count(*) as count from (select unnest(string_split(text, ' ')) as word from documents) group by word"


def _running_counts(t: Tables, *filters):
    """Whole-stream word counts, kept by changes; one result per filter.

    The filter is applied to the kept counts: a count that no longer passes is a change, too.
    """
    lines = stream_table(t.spark, t.sf_dir, "documents")
    roots, running = [], []
    for _ in filters:
        root, checkpoint = new_folder(t.spark, "counts"), new_folder(t.spark, "counts-checkpoint")
        versions.create(t.spark, root, {"counts": "word string, count bigint, _batch bigint"})
        write = sinks.changes_into(root, "counts", ["word"], checkpoint)
        running.append(sinks.start(ev.word_counts(lines, "text"), checkpoint, batch=write, mode="update"))
        roots.append(root)
    sinks.finish(*running)
    return [keep(sinks.read_changes(t.spark, root, "counts", ["word"])) for keep, root in zip(filters, roots)]


@query("x03_running_word_count", _WORDS_SQL)
def x03(t: Tables):
    return _running_counts(t, lambda counts: counts)[0]


@query("x04_per_batch_word_count", f"select word, cast(sum(count) as bigint) as count from ({_WORDS_SQL}) group by word")
def x04(t: Tables):
    """Counts start over with every batch; the table is one batch if it is one file, so the sums are compared."""
    out = new_folder(t.spark, "batches")
    lines = stream_table(t.spark, t.sf_dir, "documents", maxFilesPerTrigger="1").select("text")
    count = sinks.per_batch(out, lambda rows: ev.word_counts(spread(rows), "text"))
    sinks.finish(sinks.start(lines, new_folder(t.spark, "batches-checkpoint"), batch=count))
    return t.spark.read.parquet(f"{out}/*").groupBy("word").agg(F.sum("count").alias("count"))


@query("x05_even_words", f"select * from ({_WORDS_SQL}) where count % 2 = 0")
def x05(t: Tables):
    return _running_counts(t, ev.even_words)[0]


@query(
    "x06_two_queries_one_stream",
    f"""select 'even' as question, word, count from ({_WORDS_SQL}) where count % 2 = 0 union all
        select 'odd, long', word, count from ({_WORDS_SQL}) where count % 2 = 1 and length(word) > 1""",
)
def x06(t: Tables):
    even, odd = _running_counts(t, ev.even_words, ev.odd_long_words)
    name = F.lit
    return even.select(name("even").alias("question"), "word", "count").unionByName(
        odd.select(name("odd, long").alias("question"), "word", "count")
    )


@query("x07_console_sink", "select count(*) as input_rows from events")
def x07(t: Tables):
    """Prints the counts per event type; the result is what the stream says it has read."""
    counts = stream_table(t.spark, t.sf_dir, "events").groupBy("event_type").count()
    stream = sinks.start(counts, new_folder(t.spark, "console"), "console", mode="complete", truncate="false")
    sinks.finish(stream)
    return sinks.progress(t.spark, stream).agg(F.sum("input_rows").alias("input_rows"))


s.CTE["enriched"] = """
select *, strftime(ts, '%Y-%m-%d') as d, case when shape = 'ok' then strftime(ts, '%Y-%m-%d') end as full_date, case when shape = 'ok' then strftime(ts, '%H:%M:%S') end as full_time,
  case when id is not null then sha256(id || coalesce(product_id, '')) end as sales_key, case when ip is not null then sha256(ip) end as ip_key,
  case when user_agent is not null then sha256(user_agent) end as user_agent_key from parsed"""


@query(
    "x08_event_enrichment",
    s.with_("clicks", "parsed", "enriched")
    + """select id, sales_key, ip_key, user_agent_key, product_id as product_key, full_date, full_time, referrer_domain as referrer_url,
         browser, os, option, store_id from enriched""",
)
def x08(t: Tables):
    """The batch form; the star load below runs the same function on the stream."""
    return ev.enrich(messages(t)).select(
        "id", "sales_key", "ip_key", "user_agent_key", "product_key", "full_date", "full_time", "referrer_url",
        "browser", "os", "option", "store_id",
    )


def _loaded_star(t: Tables, runs: int = 1, writers: int | None = None, files: int | None = None):
    """Run the star load; every run starts from its own checkpoint and so replays the whole stream.

    With ``files`` the records arrive in that many files, of which a batch takes no more than two.
    """
    root = new_folder(t.spark, "star")
    star.create_star(t.spark, root)
    records = record_stream(t)
    if files:
        folder = new_folder(t.spark, "arrivals")
        messages(t).repartition(files, "offset").write.parquet(folder)
        records = t.spark.readStream.schema(records.schema).option("maxFilesPerTrigger", "2").parquet(folder)
    for _ in range(runs):
        checkpoint = new_folder(t.spark, "star-checkpoint")
        load = star.batch_loader(root, ev.enrich, writers, source=checkpoint)
        sinks.finish(sinks.start(records, checkpoint, batch=load))
    return root


_STAR_SQL = """
select 'dim_product' as "table", count(distinct product_id) as rows from enriched
union all select 'dim_location', count(distinct ip) from enriched
union all select 'dim_user_agent', count(distinct user_agent) from enriched
union all select 'fact_sales', count(distinct sales_key) from enriched"""


def _star_sizes(t: Tables, root: str):
    sizes = None
    for name in star.TABLES:
        n = star.star_table(t.spark, root, name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        sizes = n if sizes is None else sizes.unionByName(n)
    return sizes


@query("x09_star_load", s.with_(*READ, "enriched") + _STAR_SQL)
def x09(t: Tables):
    return _star_sizes(t, _loaded_star(t))


@query(
    "x10_load_from_tasks",
    s.with_(*READ, "enriched")
    + "select sales_key, min(full_date || full_time) as first_seen, cast(1 as bigint) as rows from enriched where sales_key is not null group by 1",
)
def x10(t: Tables):
    """All four tables are loaded, each from four tasks; the first row per key stays."""
    fact = star.star_table(t.spark, _loaded_star(t, writers=4), "fact_sales")
    seen = F.concat("full_date", "full_time")
    return fact.groupBy("sales_key").agg(F.min(seen).alias("first_seen"), F.count("*").alias("rows"))


@query("x10_star_from_tasks", s.with_(*READ, "enriched") + _STAR_SQL)
def x10_star(t: Tables):
    return _star_sizes(t, _loaded_star(t, writers=2))


@query(
    "x11_idempotent_insert",
    s.with_(*READ, "enriched")
    + """select sales_key, full_date, full_time, product_key, store_id from (select *, product_id as product_key,
         row_number() over (partition by sales_key order by full_date, full_time, ip_key nulls first, user_agent_key nulls first) as r
         from enriched where sales_key is not null) where r = 1""",
)
def x11(t: Tables):
    """The stream is loaded twice; the first row per key stays and nothing is doubled.

    All records come in one batch, for of several batches the first that brings a key wins, whatever its time.
    """
    fact = star.star_table(t.spark, _loaded_star(t, runs=2), "fact_sales")
    return fact.select("sales_key", "full_date", "full_time", "product_key", "store_id")


@query("x11_star_of_many_batches", s.with_(*READ, "enriched") + _STAR_SQL)
def x11_batches(t: Tables):
    """Loaded in several batches, and once more: each table has one row per key."""
    return _star_sizes(t, _loaded_star(t, runs=2, files=4))


@query("x12_skip_empty_batch", "select cast(0 as bigint) as loads, cast(0 as bigint) as rows where (select count(*) from events) > 0")
def x12(t: Tables):
    """No record passes the filter, so the batch function must not write."""
    root = new_folder(t.spark, "empty")
    star.create_star(t.spark, root)
    before = versions.current(t.spark, root).number
    none = record_stream(t).where("offset < 0")
    load = star.batch_loader(root, ev.enrich)
    sinks.finish(sinks.start(none, new_folder(t.spark, "empty-checkpoint"), batch=load))
    fact = star.star_table(t.spark, root, "fact_sales")
    loads = versions.current(t.spark, root).number - before
    return fact.agg(F.lit(loads).cast("bigint").alias("loads"), F.count("*").alias("rows"))


@query("x13_checkpointed_restart", "select count(*) as first_run, count(*) as after_restart from events")
def x13(t: Tables):
    """A second run on the same checkpoint finds nothing new."""
    out, checkpoint = new_folder(t.spark, "restart"), new_folder(t.spark, "restart-checkpoint")
    counts = []
    for _ in range(2):
        sinks.finish(sinks.start(record_stream(t).select("offset"), checkpoint, "parquet", out))
        counts.append(t.spark.read.parquet(out).count())
    return t.spark.read.parquet(out).agg(
        F.lit(counts[0]).cast("bigint").alias("first_run"), F.count("*").alias("after_restart")
    )


@query(
    "x14_topic_relay",
    s.with_("clicks") + "select cast(user_id as varchar) as key, count(*) as records, cast(count(*) filter (shape = 'ok') as bigint) as complete from clicks where shape <> 'null' group by 1",
)
def x14(t: Tables):
    copied = ev.as_text(_to_files(t, ev.relay(record_stream(t)), "relay"))
    return copied.groupBy("key").agg(F.count("*").alias("records"), F.count_if(c("value").endswith("}")).alias("complete"))


@query(
    "x15_document_store",
    s.with_("clicks")
    + """select cast(user_id as varchar) as _kafka_key, 'product_view' as _kafka_topic, cast(user_id % 3 as integer) as _kafka_partition,
         event_id as _kafka_offset, id, true as stamped from clicks where shape = 'ok'""",
)
def x15(t: Tables):
    stored = _to_files(t, ev.documents(record_stream(t)), "documents")
    return stored.select(
        "_kafka_key", "_kafka_topic", "_kafka_partition", "_kafka_offset",
        F.get_json_object("document", "$.id").alias("id"), c("_processed_at").isNotNull().alias("stamped"),
    )


@query(
    "x16_dead_letters",
    s.with_("clicks") + """select event_id as "offset", cast(40 as integer) as length from clicks where shape = 'cut'""",
)
def x16(t: Tables):
    bad = _to_files(t, ev.dead_letters(record_stream(t)), "dead-letters")
    return bad.select("offset", F.length("value").alias("length"))


@query("x17_bounded_intake", "select count(*) as rows, true as within_limit from events")
def x17(t: Tables):
    """At most one file per batch; with a broker the limit is maxOffsetsPerTrigger."""
    folder, out = new_folder(t.spark, "arrivals"), new_folder(t.spark, "intake")
    t.events.select("event_id").repartition(7).write.parquet(folder)
    source = t.spark.readStream.schema("event_id bigint").option("maxFilesPerTrigger", "1").parquet(folder)
    write = sinks.counted(out)
    sinks.finish(sinks.start(source, new_folder(t.spark, "intake-checkpoint"), batch=write))
    kept = sinks.read_counted(t.spark, out)
    return kept.agg(F.sum("input_rows").alias("rows"), (F.count_if(c("input_rows") > 0) == 7).alias("within_limit"))


@query("x18_replay_or_resume", "select count(*) as first_run, cast(0 as bigint) as resumed, count(*) as replayed from events")
def x18(t: Tables):
    """The old checkpoint resumes behind the last record, a new one replays them all."""
    old, new = new_folder(t.spark, "offsets"), new_folder(t.spark, "offsets")
    outs = []
    for checkpoint in (old, old, new):
        out = new_folder(t.spark, "replay")
        sinks.finish(sinks.start(record_stream(t).select("offset"), checkpoint, "parquet", out))
        outs.append(out)
    first = t.spark.read.schema("offset bigint").parquet(outs[0]).agg(F.count("*").alias("first_run"))
    counts = [t.spark.read.schema("offset bigint").parquet(p).count() for p in outs[1:]]
    return first.select(
        "first_run", F.lit(counts[0]).cast("bigint").alias("resumed"), F.lit(counts[1]).cast("bigint").alias("replayed")
    )


@query(
    "x19_progress_counters",
    s.with_("clicks")
    + """select count(*) as input_rows, cast(count(*) filter (shape <> 'null') as bigint) as with_value,
         cast(count(*) filter (shape = 'cut') as bigint) as cut_off from clicks""",
)
def x19(t: Tables):
    text = c("value").cast("string")
    folder = new_folder(t.spark, "progress")
    watch = sinks.counted(folder, {"with_value": F.count(text), "cut_off": F.count_if(~text.endswith("}"))})
    sinks.finish(sinks.start(record_stream(t), new_folder(t.spark, "progress-checkpoint"), batch=watch))
    batches = sinks.read_counted(t.spark, folder, "with_value", "cut_off")
    return batches.agg(
        F.sum("input_rows").alias("input_rows"), F.sum("with_value").alias("with_value"), F.sum("cut_off").alias("cut_off"),
    )


@query("x19_listened_progress", "select count(*) as input_rows, cast(1 as bigint) as ends, cast(0 as bigint) as failed from events")
def x19_listened(t: Tables):
    """A plain file sink, counted from outside by what Spark tells of every batch."""
    log = sinks.ProgressLog(t.spark, new_folder(t.spark, "log"))
    t.spark.streams.addListener(log)
    try:
        out, checkpoint = new_folder(t.spark, "listened"), new_folder(t.spark, "listened-checkpoint")
        stream = sinks.start(record_stream(t).select("offset"), checkpoint, "parquet", out)
        sinks.finish(stream)
        log.wait(stream)
    finally:
        t.spark.streams.removeListener(log)
    mine = log.rows().where(c("run") == str(stream.runId))
    return mine.agg(F.sum("input_rows").alias("input_rows"), F.count_if(c("event") == "end").alias("ends"), F.count("error").alias("failed"))


@query(
    "q16_placeholder_dimension_rows",
    s.with_(*READ, "enriched")
    + """select 'product' as dimension, product_id as key, cast(null as varchar) as text from (select distinct product_id from enriched where product_id is not null)
         union all select distinct 'location', ip_key, ip from enriched where ip is not null
         union all select distinct 'user agent', user_agent_key, browser || ' ' || os from enriched where user_agent is not null""",
)
def q16(t: Tables):
    """What an event batch adds to the dimensions: keys, and attributes only where the event has them."""
    events = ev.enrich(messages(t))
    products, locations, agents = star.product_rows(events), star.location_rows(events), star.user_agent_rows(events)
    name = F.lit
    return (
        products.select(name("product").alias("dimension"), c("product_key").alias("key"), c("name").alias("text"))
        .unionByName(locations.select(name("location").alias("dimension"), c("ip_key").alias("key"), c("ip_address").alias("text")))
        .unionByName(
            agents.select(
                name("user agent").alias("dimension"), c("user_agent_key").alias("key"),
                F.concat_ws(" ", "browser", "os").alias("text"),
            )
        )
        .distinct()
    )


@query(
    "q17_fact_projection",
    s.with_(*READ, "enriched")
    + """select distinct sales_key, full_date, full_time, ip_key, user_agent_key, product_id as product_key, referrer_domain as referrer_url,
         collection, option, email_address, resolution, user_id_db, device_id, api_version, store_id, local_time, show_recommendation,
         recommendation, utm_source, utm_medium from enriched where sales_key is not null""",
)
def q17(t: Tables):
    """The twenty fact columns, without rows that have no key and without whole-row repeats."""
    return star.fact_rows(ev.enrich(messages(t))).distinct()


# --- reports ----------------------------------------------------------------------

TODAY = "2024-01-15"


def views(t: Tables):
    """Page views of the report day: of each message only the fields of the reports are read."""
    return reports.page_views(messages(t)).where(c("full_date") == TODAY)


s.CTE["views"] = f"""select *, string_split(suffix, '.')[-1] as country, left(full_time, 2) as hour from enriched where full_date = '{TODAY}'"""
_REPORT = s.with_("clicks", "parsed", "enriched", "views")


def _top(df, column: str, n: int):
    counts = df.where(c(column).isNotNull()).groupBy(column).agg(F.count("*").alias("views"))
    return counts.orderBy(F.desc("views"), column).limit(n)


@query("x20_top_products_today", _REPORT + "select product_id, count(*) as views from views where product_id is not null group by 1 order by 2 desc, 1 limit 10")
def x20(t: Tables):
    return _top(views(t), "product_id", 10)


@query("x21_top_countries_today", _REPORT + "select country, count(*) as views from views where country is not null group by 1 order by 2 desc, 1 limit 10")
def x21(t: Tables):
    return _top(views(t), "country", 10)


@query("x22_top_referrers_today", _REPORT + "select referrer_domain as referrer_url, count(*) as views from views where referrer_domain is not null group by 1 order by 2 desc, 1 limit 5")
def x22(t: Tables):
    return _top(views(t), "referrer_url", 5)


@query("x23_store_views_of_country", _REPORT + "select store_id, count(*) as views from views where country = 'de' group by 1")
def x23(t: Tables):
    one = views(t).where(c("country") == "de")
    return one.groupBy("store_id").agg(F.count("*").alias("views")).orderBy(F.desc("views"), "store_id")


@query("x24_hourly_views_of_product", _REPORT + "select hour, count(*) as views from views where product_id = '7' group by 1")
def x24(t: Tables):
    return views(t).where(c("product_id") == "7").groupBy("hour").agg(F.count("*").alias("views")).orderBy("hour")


@query("x25_hourly_views_by_browser_os", _REPORT + "select hour, browser, os, count(*) as views from views group by 1, 2, 3")
def x25(t: Tables):
    return views(t).groupBy("hour", "browser", "os").agg(F.count("*").alias("views"))


# --- the same reports from a stream -----------------------------------------------------


def _kept_views(t: Tables):
    """Run the stream that keeps the hourly counts; the folder of its store."""
    root = new_folder(t.spark, "views")
    reports.create(t.spark, root)
    sinks.finish(reports.keep_counts(record_stream(t), root, new_folder(t.spark, "views-checkpoint")))
    return root


_ALL_REPORTS = " union all ".join(
    f"select '{name}' as report, {first} as first, {second} as second, hour, count(*) as views from views group by 2, 3, 4"
    for name, first, second in (
        ("product", "product_id", "cast(null as varchar)"), ("country", "country", "cast(null as varchar)"),
        ("referrer", "referrer_domain", "cast(null as varchar)"), ("store", "country", "store_id"), ("client", "browser", "os"),
    )
)


@query("x20_running_top_products", _REPORT + "select product_id, count(*) as views from views where product_id is not null group by 1 order by 2 desc, 1 limit 10")
def x20_running(t: Tables):
    return reports.top(t.spark, _kept_views(t), "product", TODAY, 10).withColumnRenamed("first", "product_id")


@query("x25_running_hourly_views", _REPORT + _ALL_REPORTS)
def x25_running(t: Tables):
    """Every report of the day by the hour, as the stream has kept it."""
    root = _kept_views(t)
    every = [reports.counts_of(t.spark, root, name, TODAY).withColumn("report", F.lit(name)) for name in reports.REPORTS]
    return reduce(DataFrame.unionByName, every)
