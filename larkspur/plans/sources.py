"""Source and sink queries: each writes whole tables to the shared folder and reads them back."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.money import exchange_rates
from larkspur.operators import profile
from larkspur.operators.mutation import unique_name
from larkspur.plans import standins as s
from larkspur.plans.registry import Tables, query
from larkspur.session import new_folder, stream_table
from larkspur.sources import readers, writers
from larkspur.sources.literal import literal_rows
from larkspur.streaming import sinks

c = F.col


@query("s01_csv_scan", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def s01(t: Tables):
    folder = new_folder(t.spark, "csv")
    writers.write_csv(t.customer, folder)
    return readers.read_csv(t.spark, folder, t.customer.schema)


@query("s02_csv_quoted_subset", "select doc_id, text from documents")
def s02(t: Tables):
    """Texts with separators, quotes and line breaks; two of five columns are read."""
    folder = new_folder(t.spark, "quoted")
    writers.write_csv(t.documents, folder, rows_per_file=10_000)
    return readers.read_csv(t.spark, folder, t.documents.schema, ["doc_id", "text"], multiLine=True)


@query(
    "s03_json_folder",
    s.with_("flights2") + """select id, "DEST", "ORIGIN", "CANCELLED" from flights2 where "CANCELLED" = 1""",
)
def s03(t: Tables):
    folder, flights = new_folder(t.spark, "json"), s.flights2(t)
    flights.write.json(folder)
    read = readers.read_json(t.spark, folder, flights.schema)
    return read.where(c("CANCELLED") == 1).select("id", "DEST", "ORIGIN", "CANCELLED")


@query("s04_parquet_scan", "select l_orderkey, l_quantity from lineitem where l_quantity > 45")
def s04(t: Tables):
    return t.lineitem.where(c("l_quantity") > 45).select("l_orderkey", "l_quantity")


def columnar_format(spark) -> str:
    """The format of the columnar exports: avro where the session names it, else orc, which is always there."""
    return spark.conf.get("larkspur.columnar.format", "orc")


@query(
    "s05_avro_scan",
    s.with_("flights1", "flights2")
    + """select "OP_CARRIER", "ORIGIN", cast(count(*) filter ("CANCELLED" = 1) as bigint) as "CANCELLED_COUNT"
         from flights1 join flights2 using (id) group by 1, 2""",
)
def s05(t: Tables):
    folder, fmt = new_folder(t.spark, "columnar"), columnar_format(t.spark)
    flights = s.flights1(t).join(s.flights2(t), "id")
    flights.write.format(fmt).save(folder)
    read = readers.read_files(t.spark, fmt, folder)
    return read.groupBy("OP_CARRIER", "ORIGIN").agg(F.count(F.when(c("CANCELLED") == 1, 1)).alias("CANCELLED_COUNT"))


@query(
    "s06_text_lines",
    """select cast(count(*) filter (contains(value, 'a')) as bigint) as with_a, cast(count(*) filter (contains(value, 'b')) as bigint) as with_b, count(*) as lines
       from (select unnest(string_split(text, chr(10))) as value from documents)""",
)
def s06(t: Tables):
    folder = new_folder(t.spark, "text")
    t.documents.select(c("text").alias("value")).write.text(folder)
    lines = t.spark.read.option("lineSep", "\n").text(folder)
    return lines.agg(
        F.count_if(c("value").contains("a")).alias("with_a"),
        F.count_if(c("value").contains("b")).alias("with_b"),
        F.count("*").alias("lines"),
    )


@query(
    "s07_literal_rows",
    """select label, count(*) as orders from orders join (values ('1-URGENT', 'now'), ('2-HIGH', 'soon'), ('3-MEDIUM', 'later')) v(p, label)
       on o_orderpriority = p group by label""",
)
def s07(t: Tables):
    labels = literal_rows(t.spark, [("1-URGENT", "now"), ("2-HIGH", "soon"), ("3-MEDIUM", "later")], "p string, label string")
    return t.orders.join(labels, c("o_orderpriority") == c("p")).groupBy("label").agg(F.count("*").alias("orders"))


@query(
    "s08_table_read_with_limit",
    """select count(*) as rows, cast(count(o_orderdate) as bigint) as dates, least(1000, count(*)) as limited from orders""",
)
def s08(t: Tables):
    """Text dates are parsed on the way; the limited read returns that many rows."""
    name = unique_name("orders_text")
    writers.save_table(t.orders.withColumn("created_date", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")), name)
    parsed = readers.read_table(t.spark, name, date_columns=["created_date"])
    limited = readers.read_table(t.spark, name, limit=1000).count()
    return parsed.agg(
        F.count("*").alias("rows"), F.count("created_date").alias("dates"), F.lit(limited).cast("bigint").alias("limited")
    )


@query("s10_table_write_modes", "select count(*) as first, count(*) as appended, count(*) as replaced, true as refused, count(*) as rows from supplier")
def s10(t: Tables):
    name = unique_name("vendors")
    counts = [writers.save_table(t.supplier, name)]
    try:
        writers.save_table(t.supplier, name)
        refused = False
    except Exception:
        refused = True
    counts += [writers.save_table(t.supplier, name, "append"), writers.save_table(t.supplier, name, "replace")]
    first, appended, replaced = (F.lit(n).cast("bigint") for n in counts)
    return t.spark.table(name).agg(
        first.alias("first"), appended.alias("appended"), replaced.alias("replaced"),
        F.lit(refused).alias("refused"), F.count("*").alias("rows"),
    )


@query(
    "s11_csv_sink",
    s.with_("films") + "select id, original_title, cast(vote_average as varchar) as vote_average from films where vote_average > 7.5",
)
def s11(t: Tables):
    folder = new_folder(t.spark, "rated")
    writers.write_csv(s.films(t).where(c("vote_average") > 7.5).select("id", "original_title", "vote_average"), folder)
    return readers.read_csv(t.spark, folder, "id bigint, original_title string, vote_average string")


@query(
    "s12_partitioned_json_sink",
    s.with_("flights1", "flights2")
    + """select "OP_CARRIER", count(*) as rows, true as within_cap from flights1 join flights2 using (id) where "DEST" = '5-LOW' group by 1""",
)
def s12(t: Tables):
    """Folders per carrier and destination; reading one destination touches only its folders."""
    folder = new_folder(t.spark, "partitioned")
    flights = s.flights1(t).join(s.flights2(t), "id")
    writers.write_partitioned(flights, folder, ["OP_CARRIER", "DEST"], rows_per_file=10_000)
    read = readers.read_json(t.spark, folder, "id bigint, FL_DATE string, ORIGIN string, OP_CARRIER string, DEST string")
    per_file = (
        read.where(c("DEST") == "5-LOW")
        .groupBy("OP_CARRIER", F.col("_metadata.file_path").alias("file"))
        .agg(F.count("*").alias("n"))
    )
    return per_file.groupBy("OP_CARRIER").agg(
        F.sum("n").alias("rows"), (F.max("n") <= 10_000).alias("within_cap")
    )


@query("s13_repartitioned_sink", "select count(*) as rows, cast(sum(l_quantity) as bigint) as quantity, cast(5 as bigint) as files from lineitem")
def s13(t: Tables):
    folder, fmt = new_folder(t.spark, "five"), columnar_format(t.spark)
    writers.write_repartitioned(t.lineitem.select("l_orderkey", "l_quantity"), folder, 5, fmt)
    read = readers.read_files(t.spark, fmt, folder)
    return read.agg(
        F.count("*").alias("rows"),
        F.sum(c("l_quantity").cast("bigint")).alias("quantity"),
        F.count_distinct("_metadata.file_path").alias("files"),
    )


@query("s14_fixed_size_batches", "select count(*) as rows, true as all_within from orders")
def s14(t: Tables):
    folder = new_folder(t.spark, "export")
    writers.write_batches(t.orders.select("o_orderkey", "o_custkey"), folder, 1000)
    files = t.spark.read.parquet(folder).groupBy("_metadata.file_path").agg(F.count("*").alias("n"))
    return files.agg(F.sum("n").alias("rows"), (F.max("n") <= 1000).alias("all_within"))


@query(
    "s14_exact_batches",
    """select cast(count(*) // 1000 as bigint) as full_files, cast(case when count(*) % 1000 > 0 then 1 else 0 end as bigint) as other_files, count(*) as rows from orders""",
)
def s14_exact(t: Tables):
    """All files but the last hold the given number of rows, however the rows were partitioned."""
    folder = new_folder(t.spark, "export")
    writers.write_batches(t.orders.select("o_orderkey").repartition(7), folder, 1000)
    files = t.spark.read.parquet(folder).groupBy("_metadata.file_path").agg(F.count("*").alias("n"))
    return files.agg(F.count_if(c("n") == 1000).alias("full_files"), F.count_if(c("n") != 1000).alias("other_files"), F.sum("n").alias("rows"))


@query(
    "s15_csv_to_target_schema",
    "select p_partkey as product_id, p_name as name, cast(p_retailprice as double) as price, cast(null as varchar) as url, try_cast(p_brand as integer) as code from part",
)
def s15(t: Tables):
    """Columns the source lacks, and text that does not fit a type, become NULL."""
    source, target = new_folder(t.spark, "raw"), new_folder(t.spark, "typed")
    raw = t.part.select(
        c("p_partkey").alias("product_id"), c("p_name").alias("name"), c("p_retailprice").alias("price"),
        F.lit(None).cast("string").alias("url"), c("p_brand").alias("code"),
    )
    writers.write_csv(raw, source)
    schema = T.DataType.fromDDL("product_id bigint, name string, price double, url string, code int")
    fmt = columnar_format(t.spark)
    writers.convert_csv(t.spark, source, target, schema, fmt)
    return readers.read_files(t.spark, fmt, target, schema)


@query(
    "s15_missing_column",
    "select p_partkey as product_id, cast(null as varchar) as url, cast(p_size as integer) as size, cast(null as double) as weight from part",
)
def s15_missing(t: Tables):
    """The files lack two target columns and have others in another order."""
    source, target = new_folder(t.spark, "raw"), new_folder(t.spark, "typed")
    writers.write_csv(t.part.select(c("p_size").alias("size"), c("p_name").alias("name"), c("p_partkey").alias("product_id")), source)
    schema = T.DataType.fromDDL("product_id bigint, url string, size int, weight double")
    fmt = columnar_format(t.spark)
    writers.convert_csv(t.spark, source, target, schema, fmt)
    return readers.read_files(t.spark, fmt, target, schema)


@query(
    "s15_headers_by_file",
    """select p_partkey as id, p_name as name, cast(null as integer) as size from part where p_partkey % 3 = 0 union all
       select p_partkey, p_name, cast(p_size as integer) from part where p_partkey % 3 = 1 union all
       select p_partkey, null, cast(p_size as integer) from part where p_partkey % 3 = 2""",
)
def s15_headers(t: Tables):
    """Three kinds of files in one folder: other columns, and another order."""
    source, target = new_folder(t.spark, "raw"), new_folder(t.spark, "typed")
    columns = [c("p_partkey").alias("id"), c("p_name").alias("name"), c("p_size").alias("size")]
    for i, chosen in enumerate(([0, 1], [2, 1, 0], [0, 2])):
        writers.write_csv(t.part.where(c("p_partkey") % 3 == i).select(*[columns[k] for k in chosen]), source, "append")
    schema = T.DataType.fromDDL("id bigint, name string, size int")
    writers.convert_csv(t.spark, source, target, schema)
    return readers.read_files(t.spark, "parquet", target, schema)


@query(
    "s16_folder_to_table_load",
    "select 'products' as folder, count(*) as rows from part union all select 'locations', count(*) from supplier",
)
def s16(t: Tables):
    """Loading twice leaves the tables with one copy."""
    root = new_folder(t.spark, "landing")
    t.part.write.parquet(f"{root}/products/day=1")
    t.supplier.write.parquet(f"{root}/locations/day=1")
    names = {"products": unique_name("products"), "locations": unique_name("locations")}
    writers.load_folders(t.spark, root, names)
    tables = writers.load_folders(t.spark, root, names)
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("folder"), "rows") for name, df in tables.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "s17_glob_ingest",
    """select cast(p_partkey as varchar) as product_key, min(name) as name, min(current_url) as current_url from
       (select p_partkey, p_name as name, 'https://www.shop.de/' || p_partkey as current_url from part union all
        select p_partkey, p_name || ' copy', 'https://www.shop.de/' || p_partkey from part where p_partkey % 4 = 0) group by 1""",
)
def s17(t: Tables):
    root = new_folder(t.spark, "files")
    url = F.concat(F.lit("https://www.shop.de/"), c("p_partkey").cast("string")).alias("url")
    base = t.part.select(c("p_partkey").alias("product_id"), c("p_name").alias("name"), url, F.lit("de").alias("language_code"))
    writers.write_csv(base, f"{root}/prod_1")
    copies = base.where(c("product_id") % 4 == 0).withColumn("name", F.concat("name", F.lit(" copy")))
    writers.write_csv(copies, f"{root}/prod_2")
    schema = T.DataType.fromDDL("product_id bigint, name string, url string, language_code string")
    names = {"product_id": "product_key", "name": "name", "url": "current_url"}
    return writers.ingest_csv_files(t.spark, f"{root}/prod_*", schema, names, "product_key")


@query("s18_skip_processed_files", "select 'stream' as form, count(*) as first, cast(0 as bigint) as second from events union all select 'manifest', count(*), cast(0 as bigint) from events")
def s18(t: Tables):
    out, checkpoint = new_folder(t.spark, "once"), new_folder(t.spark, "once-checkpoint")
    counts = [0]
    for _ in range(2):
        source = stream_table(t.spark, t.sf_dir, "events").select("event_id")
        sinks.finish(sinks.start(source, checkpoint, "parquet", out))
        counts.append(t.spark.read.parquet(out).count())
    nothing = literal_rows(t.spark, [], "path string")
    done = t.events.select(c("_metadata.file_path").alias("path")).distinct()
    first = writers.unprocessed(t.events, nothing).agg(F.count("*").alias("first"))
    second = writers.unprocessed(t.events, done).agg(F.count("*").alias("second"))
    by_stream = literal_rows(
        t.spark, [("stream", counts[1], counts[2] - counts[1])], "form string, first bigint, second bigint"
    )
    both = first.select("first", F.lit(0).cast("bigint").alias("second")).unionByName(
        second.select(F.lit(0).cast("bigint").alias("first"), "second")
    )
    by_manifest = both.agg(F.sum("first").alias("first"), F.sum("second").alias("second"))
    return by_stream.unionByName(by_manifest.select(F.lit("manifest").alias("form"), "first", "second"))


@query(
    "s19_binary_files",
    "select cast(sum(strlen(html) + 1) as bigint) as bytes, 'txt' as file_extension from pages",
)
def s19(t: Tables):
    """Files as rows of bytes: the sizes add up to the texts that were written."""
    folder = new_folder(t.spark, "blobs")
    t.pages.select("html").write.option("maxRecordsPerFile", 1000).text(folder)
    files = readers.read_files(t.spark, "binaryFile", folder, pathGlobFilter="part-*")
    blobs = writers.store_blobs(files, r"part-(\d+)")
    return blobs.groupBy("file_extension").agg(F.sum(F.octet_length("drawing_data")).cast("bigint").alias("bytes"))


@query(
    "s19_blob_by_key",
    "select page_id, url, sha256(html) as digest from pages where url like '%/en/%'",
)
def s19_blob(t: Tables):
    """Bytes stored in a table and fetched by a join with the rows that are wanted."""
    folder = new_folder(t.spark, "blob-table")
    t.pages.select("page_id", c("html").cast("binary").alias("data")).write.parquet(folder)
    wanted = t.pages.where(c("url").like("%/en/%")).select("page_id", "url")
    return t.spark.read.parquet(folder).join(wanted, "page_id").select("page_id", "url", F.sha2("data", 256).alias("digest"))


@query(
    "s19_blob_round_trip",
    "select cast(page_id % 40 as varchar) as id, sha256(string_agg(html, chr(10) order by page_id) || chr(10)) as digest from pages where page_id % 40 % 2 = 0 group by 1",
)
def s19_round_trip(t: Tables):
    """Files of pages stored as blobs, and those with an even id fetched by it."""
    folder, table = new_folder(t.spark, "blobs"), new_folder(t.spark, "blob-table")
    pages = t.pages.select((c("page_id") % 40).alias("id"), "page_id", "html")
    pages.repartition("id").sortWithinPartitions("id", "page_id").select("id", "html").write.partitionBy("id").text(folder)
    files = t.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(folder)
    writers.store_blobs(files, r"^id=(\d+)/", folders=1).write.parquet(table)
    wanted = t.pages.select((c("page_id") % 40).cast("string").alias("id")).distinct().where("cast(id as int) % 2 = 0")
    return t.spark.read.parquet(table).join(wanted, "id").select("id", F.sha2("drawing_data", 256).alias("digest"))


@query(
    "s20_seed_lookup",
    s.with_("fx") + """select code, count(*) as orders from orders join fx on symbol = case o_custkey % 4 when 0 then '€' when 1 then '£' when 2 then 'zł' else '₫' end group by 1""",
)
def s20(t: Tables):
    symbol = s.pick(c("o_custkey"), "€", "£", "zł", "₫")
    return t.orders.join(exchange_rates(t.spark), c("symbol") == symbol).groupBy("code").agg(F.count("*").alias("orders"))


@query(
    "s21_view_and_sql",
    s.with_("survey") + """select "Country", count(1) as count from survey where "Age" < 40 group by "Country" """,
)
def s21(t: Tables):
    s.survey(t).createOrReplaceTempView("survey_view")
    return t.spark.sql("select Country, count(1) as count from survey_view where Age < 40 group by Country order by count(1) desc")


@query(
    "s22_parameterised_query",
    """select 'args' as form, p_partkey as part_id, p_name as part_name from part join (select distinct l_partkey from lineitem where l_suppkey = 5) on l_partkey = p_partkey
       union all select 'function', p_partkey, p_name from part join (select distinct l_partkey from lineitem where l_suppkey = 5) on l_partkey = p_partkey""",
)
def s22(t: Tables):
    body = """select distinct p.p_partkey as part_id, p.p_name as part_name
              from vendor_lines l join vendor_parts_list p on l.l_partkey = p.p_partkey where l.l_suppkey = {id}"""
    t.lineitem.createOrReplaceTempView("vendor_lines")
    t.part.createOrReplaceTempView("vendor_parts_list")
    t.spark.sql(
        "create or replace temporary function parts_of_vendor(vendor bigint) returns table (part_id bigint, part_name string) return "
        + body.format(id="vendor")
    )
    by_args = readers.query_with(t.spark, body.format(id=":id"), {"id": 5})
    by_function = t.spark.sql("select * from parts_of_vendor(5)")
    return by_args.select(F.lit("args").alias("form"), "*").unionByName(
        by_function.select(F.lit("function").alias("form"), "*")
    )


_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    "s23_table_profile",
    " union all ".join(
        f"""select '{x}' as "column", 'double' as type, cast(count({x}) as bigint) as non_null, round(avg({x}), 4) as mean, round(stddev_samp({x}), 4) as std,
            min({x}) as min, quantile_cont({x}, 0.25) as q1, median({x}) as median, quantile_cont({x}, 0.75) as q3, max({x}) as max from lineitem"""
        for x in _NUMBERS
    )
    + """ union all select 'l_returnflag', 'string', cast(count(l_returnflag) as bigint), null, null, null, null, null, null, null from lineitem""",
)
def s23(t: Tables):
    rows = profile.table_profile(t.lineitem.select(*_NUMBERS, "l_returnflag"))
    return rows.withColumns({x: F.round(x, 4) for x in ("mean", "std")})


@query("s24_rows_per_partition", "select cast(5 as bigint) as partitions, count(*) as rows, true as even from lineitem")
def s24(t: Tables):
    counts = profile.rows_per_partition(t.lineitem.repartition(5))
    return counts.agg(
        F.count("*").alias("partitions"), F.sum("count").alias("rows"), (F.max("count") <= F.min("count") * 2).alias("even")
    )


@query(
    "s25_cache_and_release",
    "select cast(count(*) filter (contains(text, 'a')) as bigint) as with_a, cast(count(*) filter (contains(text, 'b')) as bigint) as with_b from documents",
)
def s25(t: Tables):
    """Two counts over one held scan, which is let go before the result is returned."""
    held = t.documents.select("text").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        row = (held.where(c("text").contains("a")).count(), held.where(c("text").contains("b")).count())
    finally:
        held.unpersist()
    return literal_rows(t.spark, [row], "with_a bigint, with_b bigint")
