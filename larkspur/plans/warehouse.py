"""Warehouse, table change and data test queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions import text
from larkspur.functions.money import exchange_rates, salary_columns
from larkspur.operators import mutation as m
from larkspur.operators import quality as q
from larkspur.operators import versions as v
from larkspur.operators import warehouse as w
from larkspur.plans import standins as s
from larkspur.plans.clicks import carts
from larkspur.plans.joins import jobs
from larkspur.plans.registry import Tables, query
from larkspur.session import cut_lineage, new_folder
from larkspur.sources.literal import literal_rows

c = F.col


def sha(*parts):
    """Checks use SHA-256 keys, which both engines compute alike."""
    return F.sha2(F.concat(*[p.cast("string") for p in parts]), 256)


# --- sources ----------------------------------------------------------------------

s.CTE["ip_location"] = """
select concat_ws('.', s_suppkey % 223 + 1, s_suppkey % 256, 0, 1) as ip, 'C' || s_nationkey as country_short,
       case when s_suppkey % 13 = 0 then '-' else 'Country ' || s_nationkey end as country_long,
       case s_suppkey % 5 when 0 then '-' when 1 then ' ' else 'R' || (s_nationkey % 7) end as region,
       case s_suppkey % 4 when 0 then '-' else 'City ' || (s_suppkey % 9) end as city from supplier
union all
select concat_ws('.', s_suppkey % 223 + 1, s_suppkey % 256, 0, 1), 'C' || s_nationkey, 'Country ' || s_nationkey, 'R', 'Other city'
from supplier where s_suppkey % 10 = 0"""


def ip_location(t: Tables):
    """Located addresses; every tenth appears twice, with another city."""
    key, nation = c("s_suppkey"), c("s_nationkey").cast("string")
    ip = F.concat_ws(".", (key % 223 + 1).cast("string"), (key % 256).cast("string"), F.lit("0"), F.lit("1")).alias("ip")
    short = F.concat(F.lit("C"), nation).alias("country_short")
    country = F.concat(F.lit("Country "), nation)
    region = F.concat(F.lit("R"), (c("s_nationkey") % 7).cast("string"))
    city = F.concat(F.lit("City "), (key % 9).cast("string"))
    first = t.supplier.select(
        ip, short, F.when(key % 13 == 0, "-").otherwise(country).alias("country_long"),
        s.pick(key, "-", " ", region, region, region).alias("region"),
        s.pick(key, "-", city, city, city).alias("city"),
    )
    second = t.supplier.where(key % 10 == 0).select(
        ip, short, country.alias("country_long"), F.lit("R").alias("region"), F.lit("Other city").alias("city")
    )
    return first.unionByName(second)


s.CTE["crawled"] = """
select cast(p_partkey as varchar) as product_id, p_name as name, case p_partkey % 10 when 0 then 'fail' when 1 then 'playwright_success' else '200' end as status_code from part
union all select cast(p_partkey as varchar), 'AAA ' || p_name, 'fail' from part where p_partkey % 7 = 0"""


def crawled(t: Tables):
    """Crawled products; every seventh has a failed row that comes first by name."""
    key = c("p_partkey")
    good = F.when(key % 10 == 0, "fail").when(key % 10 == 1, "playwright_success").otherwise("200")
    first = t.part.select(key.cast("string").alias("product_id"), c("p_name").alias("name"), good.alias("status_code"))
    second = t.part.where(key % 7 == 0).select(
        key.cast("string").alias("product_id"), F.concat(F.lit("AAA "), c("p_name")).alias("name"), F.lit("fail").alias("status_code")
    )
    return first.unionByName(second)


# --- models -----------------------------------------------------------------------

s.CTE["stg_location"] = """
select sha256(ip) as location_key, ip as ip_address, country_short as country_short_name, country_long as country_long_name,
       case when trim(region) <> '' and region <> '-' then region end as region_name, case when trim(city) <> '' and city <> '-' then city end as city_name
from (select distinct * from ip_location) where country_long <> '-' and ip <> '-'"""
s.CTE["stg_product"] = """
select cast(product_id as integer) as product_key, name as product_name from
  (select *, row_number() over (partition by product_id order by name, status_code) as r from crawled)
where r = 1 and status_code in ('200', 'playwright_success')"""
s.CTE["stg_sales"] = """
select sha256(_id || '' || product_id) as sales_key, product_id as product_key, sha256(ip) as location_key,
       cast(to_timestamp(time_stamp) as date) as full_date, _id as order_key,
       sum(value * exchange_rate * amount) / sum(amount) as price, cast(sum(amount) as bigint) as amount
from items join fx on symbol = currency
where collection = 'checkout_success' and product_id is not null and price is not null and currency <> '' and amount is not null group by 1, 2, 3, 4, 5"""
s.CTE["dim_location"] = """
select distinct location_key, ip_address, country_short_name, country_long_name, coalesce(region_name, 'XNA') as region_name, coalesce(city_name, 'XNA') as city_name
from stg_location union all select '-1', 'XNA', 'XNA', 'XNA', 'XNA', 'XNA'"""
s.CTE["dim_product"] = "select distinct * from stg_product union all select -1, 'XNA'"
_DAYS = """
select cast(d as date) as full_date, dayname(d) as day_of_week, left(dayname(d), 3) as day_of_week_short,
  case when dayofweek(d) in (0, 6) then 'Weekend' else 'Weekday' end as is_weekday_or_weekend, cast(day(d) as integer) as day_of_month,
  strftime(d, '%Y-%m') as year_month, cast(month(d) as integer) as month, cast(dayofyear(d) as integer) as day_of_year,
  cast(strftime(d, '%U') as integer) as week_of_year, cast(quarter(d) as integer) as quarter_number, cast(year(d) as integer) as year_number
from (select unnest(generate_series(min(cast({day} as date))::timestamp, max(cast({day} as date))::timestamp, interval 1 day)) as d from {source})"""
s.CTE["dim_date"] = _DAYS.format(day="full_date", source="stg_sales")
s.CTE["order_days"] = _DAYS.format(day="o_orderdate", source="orders")
_SOURCES = ("fx", "carts", "items", "ip_location", "crawled", "stg_location", "stg_product", "stg_sales")


def _sales(t: Tables):
    return w.stage_sales(carts(t), exchange_rates(t.spark), sha)




@query("q11_stage_locations", s.with_("ip_location", "stg_location") + "select * from stg_location")
def q11(t: Tables):
    return w.stage_locations(ip_location(t), sha)


@query("q12_stage_products", s.with_("crawled", "stg_product") + "select * from stg_product")
def q12(t: Tables):
    return w.stage_products(crawled(t))


@query(
    "q13_stage_sales",
    s.with_("fx", "carts", "items", "stg_sales")
    + "select sales_key, product_key, location_key, strftime(full_date, '%Y-%m-%d') as full_date, order_key, round(price, 6) as price, amount from stg_sales",
)
def q13(t: Tables):
    return _sales(t).withColumns(
        {"price": F.round("price", 6), "full_date": F.date_format("full_date", "yyyy-MM-dd")}
    )


@query("q14_dim_location", s.with_("ip_location", "stg_location", "dim_location") + "select * from dim_location")
def q14_location(t: Tables):
    return w.dim_location(w.stage_locations(ip_location(t), sha), "-1")


@query("q14_dim_product", s.with_("crawled", "stg_product", "dim_product") + "select * from dim_product")
def q14_product(t: Tables):
    return w.dim_product(w.stage_products(crawled(t)))


@query(
    "q14_dim_date_usage",
    s.with_("order_days")
    + """select year_month, is_weekday_or_weekend, cast(min(week_of_year) as integer) as first_week, count(*) as orders
         from orders join order_days on cast(o_orderdate as date) = full_date group by 1, 2""",
)
def q14_date(t: Tables):
    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("full_date")).agg(F.count("*").alias("n"))
    return (
        per_day.join(w.dim_date_of(per_day, "full_date"), "full_date")
        .groupBy("year_month", "is_weekday_or_weekend")
        .agg(F.min("week_of_year").alias("first_week"), F.sum("n").alias("orders"))
    )


@query(
    "q15_fact_sales",
    s.with_("fx", "carts", "items", "stg_sales")
    + """select sales_key, product_key, location_key, strftime(full_date, '%Y-%m-%d') as full_date, order_key,
         round(price, 6) as price, amount, round(price * amount, 6) as revenue from stg_sales""",
)
def q15(t: Tables):
    return w.fact_sales(_sales(t)).withColumns(
        {"price": F.round("price", 6), "revenue": F.round("revenue", 6), "full_date": F.date_format("full_date", "yyyy-MM-dd")}
    )


@query(
    "q15_incremental_fact",
    s.with_("fx", "carts", "items", "stg_sales")
    + """select sales_key, strftime(full_date, '%Y-%m-%d') as full_date, round(price, 6) as price, amount, round(price * amount, 6) as revenue from stg_sales""",
)
def q15_incremental(t: Tables):
    """A first run over most days, with one month's prices wrong, and a second that brings the rest and that month again.

    The fact is cut by month: the second run reads and writes the months that it brings, and no other.
    """
    fact = w.fact_sales(_sales(t)).withColumn("month", F.date_format("full_date", "yyyy-MM"))
    fact = cut_lineage(t.spark, fact, "fact")
    late = fact.where(F.month("full_date") == 12)
    again = fact.where(F.month("full_date") == 6)
    first = fact.where(F.month("full_date") < 12).withColumn("price", F.when(F.month("full_date") != 6, c("price")))
    root = _store(t, {"fact_sales": first.withColumn("revenue", c("price") * c("amount"))}, {"fact_sales": "month"})
    change = v.Change(t.spark, root)
    change.merge("fact_sales", late.unionByName(again), ["sales_key"])
    change.commit()
    return v.read(t.spark, root, "fact_sales").select(
        "sales_key", F.date_format("full_date", "yyyy-MM-dd").alias("full_date"), F.round("price", 6).alias("price"), "amount", F.round("revenue", 6).alias("revenue")
    )


@query(
    "q15_sales_flat",
    s.with_(*_SOURCES, "dim_location", "dim_product", "dim_date")
    + """select sales_key, f.product_key, f.location_key, strftime(f.full_date, '%Y-%m-%d') as full_date, order_key, amount, round(price * amount, 6) as revenue,
         country_long_name, city_name, coalesce(product_name, 'XNA') as product_name, day_of_week, year_month, week_of_year
         from stg_sales f left join dim_location l on f.location_key = l.location_key left join dim_product p on f.product_key = p.product_key
         left join dim_date d on f.full_date = d.full_date""",
)
def q15_flat(t: Tables):
    sales = _sales(t)
    flat = w.sales_flat(
        w.fact_sales(sales),
        w.dim_location(w.stage_locations(ip_location(t), sha), "-1"),
        w.dim_product(w.stage_products(crawled(t))),
        w.dim_date_of(sales, "full_date"),
    )
    return flat.select(
        "sales_key", "product_key", "location_key", F.date_format("full_date", "yyyy-MM-dd").alias("full_date"),
        "order_key", "amount", F.round("revenue", 6).alias("revenue"), "country_long_name", "city_name",
        "product_name", "day_of_week", "year_month", "week_of_year",
    )


# --- data tests -------------------------------------------------------------------


@query("q01_unique_key", "select l_orderkey, count(*) as count from lineitem group by 1 having count(*) > 1")
def q01(t: Tables):
    return q.not_unique(t.lineitem, "l_orderkey")


@query("q02_not_null", s.with_("names") + "select id, name from names where height is null")
def q02(t: Tables):
    return q.is_null(s.names(t), "height").select("id", "name")


@query(
    "q02_model_key_report",
    s.with_(*_SOURCES, "dim_location", "dim_product")
    + " union all ".join(
        f"""select '{table}' as "table", '{key}' as "column", 'unique' as test, count(*) as failures from (select {key} from {source} where {key} is not null group by 1 having count(*) > 1)
            union all select '{table}', '{key}', 'not_null', count(*) from {source} where {key} is null"""
        for table, key, source in (
            ("stg_dim_location", "location_key", "stg_location"),
            ("stg_dim_product", "product_key", "stg_product"),
            ("stg_fact_sales", "sales_key", "stg_sales"),
            ("dim_location", "location_key", "dim_location"),
            ("dim_product", "product_key", "dim_product"),
        )
    ),
)
def q02_models(t: Tables):
    locations, products, sales = w.stage_locations(ip_location(t), sha), w.stage_products(crawled(t)), _sales(t)
    return q.key_report(
        {
            "stg_dim_location": (locations, "location_key"),
            "stg_dim_product": (products, "product_key"),
            "stg_fact_sales": (sales, "sales_key"),
            "dim_location": (w.dim_location(locations, "-1"), "location_key"),
            "dim_product": (w.dim_product(products), "product_key"),
        }
    )


@query(
    "q03_row_rules",
    """select 'unit present' as rule, cast(0 as bigint) as violations union all
       select 'fixed salary has a bound', cast(0 as bigint) union all
       select 'negotiable has no bound', cast(0 as bigint) union all
       select 'size above 10', cast(count(*) filter (p_size <= 10) as bigint) from part""",
)
def q03(t: Tables):
    """The salary rules hold for all rows; the fourth rule does not."""
    cleaned = jobs(t).join(t.part.select(c("p_partkey").alias("id"), "p_size"), "id")
    cleaned = cleaned.withColumns(salary_columns(c("salary")))
    return q.rule_violations(cleaned, {**q.salary_rules(), "size above 10": c("p_size") > 10})


@query(
    "q04_foreign_key_orphans",
    """select o_orderkey, o_custkey from orders where o_custkey is not null and o_custkey not in (select c_custkey from customer where c_acctbal > 0)""",
)
def q04(t: Tables):
    return m.orphans(t.orders, "o_custkey", t.customer.where(c("c_acctbal") > 0), "c_custkey").select("o_orderkey", "o_custkey")


# --- table changes -----------------------------------------------------------------


@query("q05_create_if_absent", "select true as created_first, false as created_second, count(*) as rows from customer")
def q05(t: Tables):
    name = m.unique_name("accounts")
    schema = t.customer.schema
    first = m.create_if_absent(t.spark, name, schema)
    second = m.create_if_absent(t.spark, name, schema)
    t.customer.write.insertInto(name)
    return t.spark.table(name).agg(F.count("*").alias("rows")).select(
        F.lit(first).alias("created_first"), F.lit(second).alias("created_second"), "rows"
    )


def _store(t: Tables, tables: dict, parts: dict | None = None):
    """A store that holds these tables as its first contents; its folder."""
    root = new_folder(t.spark, "store")
    v.create(t.spark, root, {name: df.schema for name, df in tables.items()}, parts)
    change = v.Change(t.spark, root)
    for name, df in tables.items():
        change.append(name, df)
    change.commit()
    return root


def _told(t: Tables, **counts):
    """What a change returned, as one row."""
    return literal_rows(t.spark, [list(counts.values())], ", ".join(f"{name} bigint" for name in counts))


def _inserted(t: Tables):
    vendors = t.supplier.select(c("s_suppkey").alias("vendor_id"), c("s_name").alias("vendor_name"))
    root = _store(t, {"vendors": vendors})
    change = v.Change(t.spark, root)
    new = t.customer.select("c_custkey", c("c_name").alias("vendor_name"))
    counts = change.insert("vendors", new, "vendor_id", c("c_custkey"))
    change.commit()
    return root, counts


@query(
    "q06_insert_new_ids",
    """select s_suppkey as vendor_id, s_name as vendor_name from supplier union all
       select (select max(s_suppkey) from supplier) + row_number() over (order by c_custkey), c_name from customer""",
)
def q06(t: Tables):
    """Read back from storage after the insert."""
    return v.read(t.spark, _inserted(t)[0], "vendors")


@query(
    "q06_insert_returns",
    "select (select count(*) from customer) as inserted, (select max(s_suppkey) from supplier) + (select count(*) from customer) as last_id",
)
def q06_returns(t: Tables):
    inserted, last = _inserted(t)[1]
    return _told(t, inserted=inserted, last_id=last)


@query(
    "q07_update_by_key",
    """select s_suppkey, case when s_suppkey = 7 then 'Renamed' else s_name end as s_name, s_nationkey from supplier""",
)
def q07(t: Tables):
    """Read back from storage after the update."""
    root = _store(t, {"vendors": t.supplier.select("s_suppkey", "s_name", "s_nationkey")})
    change = v.Change(t.spark, root)
    change.update("vendors", c("s_suppkey") == 7, {"s_name": F.lit("Renamed")})
    change.commit()
    return v.read(t.spark, root, "vendors")


@query(
    "q07_update_returns",
    """select (select count(*) from customer where c_nationkey = 3) as changed, (select count(*) from customer where c_nationkey = 3) as with_new_name,
         (select count(*) from customer) as rows""",
)
def q07_returns(t: Tables):
    """Cut by nation: the update writes one part again, and tells how many rows it changed."""
    root = _store(t, {"clients": t.customer.select("c_custkey", "c_name", "c_nationkey")}, {"clients": "c_nationkey"})
    change = v.Change(t.spark, root)
    changed = change.update("clients", c("c_nationkey") == 3, {"c_name": F.lit("Moved")})
    change.commit()
    stored = v.read(t.spark, root, "clients")
    return stored.agg(F.lit(changed).cast("bigint").alias("changed"), F.count_if(c("c_name") == "Moved").alias("with_new_name"), F.count("*").alias("rows"))


@query(
    "q08_delete_cascade",
    """with doomed as (select p_partkey from part where p_size = 11)
       select 'part' as "table", (select count(*) from part) - (select count(*) from doomed) as kept, (select count(*) from doomed) as removed
       union all select 'vendor_parts', count(*) filter (l_partkey not in (select p_partkey from doomed)), count(*) filter (l_partkey in (select p_partkey from doomed))
       from (select distinct l_suppkey, l_partkey from lineitem)""",
)
def q08(t: Tables):
    """Parts and their vendor rows go in one commit; kept rows are counted in storage."""
    bridge = t.lineitem.select("l_suppkey", "l_partkey").distinct()
    root = _store(t, {"part": t.part, "vendor_parts": bridge})
    change = v.Change(t.spark, root)
    doomed = change.table("part").where(c("p_size") == 11).select("p_partkey")
    removed = change.delete("part", "p_partkey", doomed, {"vendor_parts": "l_partkey"})
    change.commit()
    rows = [
        v.read(t.spark, root, name).agg(F.lit(name).alias("table"), F.count("*").alias("kept"), F.lit(n).cast("bigint").alias("removed"))
        for name, n in removed.items()
    ]
    return rows[0].unionByName(rows[1])


@query(
    "q09_insert_all_or_nothing",
    """with bad as (select distinct l_orderkey as unit from lineitem where l_suppkey not in (select s_suppkey from supplier where s_nationkey < 24))
       select 'orders' as "table", count(*) as rows from orders where o_orderkey not in (select unit from bad)
       union all select 'order_vendors', count(*) from lineitem where l_orderkey not in (select unit from bad)""",
)
def q09(t: Tables):
    """Orders with their vendor rows, stored by one commit; one unknown vendor rejects the whole order."""
    parents = t.orders.select(c("o_orderkey").alias("unit"), "o_custkey")
    bridge = t.lineitem.select(c("l_orderkey").alias("unit"), "l_suppkey")
    known = t.supplier.where(c("s_nationkey") < 24)
    orders, vendors = m.insert_all_or_nothing(parents, bridge, [("l_suppkey", known, "s_suppkey")])
    root = _store(t, {"orders": orders, "order_vendors": vendors})
    parts = [v.read(t.spark, root, name).agg(F.lit(name).alias("table"), F.count("*").alias("rows")) for name in ("orders", "order_vendors")]
    return parts[0].unionByName(parts[1])


_UPSERT_SQL = """select c_custkey as id, case when c_custkey % 3 = 0 then 'changed' else c_name end as name from customer
       union all select -c_custkey - 1, 'new' from customer"""


def _customer_changes(t: Tables):
    key = c("c_custkey")
    changed = t.customer.where(key % 3 == 0).select(key.alias("id"), F.lit("changed").alias("name"))
    return changed.unionByName(t.customer.select((-key - 1).alias("id"), F.lit("new").alias("name")))


@query("q10_upsert", _UPSERT_SQL)
def q10(t: Tables):
    """Changes replace matching rows and add the others; the result is swapped in as the table."""
    name = m.unique_name("dim_customer")
    target = m.replace_table(t.customer.select(c("c_custkey").alias("id"), c("c_name").alias("name")), name)
    return m.replace_table(m.upsert(target, _customer_changes(t), ["id"]), name)


@query("q10_upsert_by_parts", _UPSERT_SQL)
def q10_parts(t: Tables):
    """The same in a store cut by buckets of the key, of which only those with changes are written again."""
    bucket = v.bucket_of(["id"], 8).alias("bucket")
    root = _store(t, {"dim_customer": t.customer.select(c("c_custkey").alias("id"), c("c_name").alias("name")).select("*", bucket)}, {"dim_customer": "bucket"})
    change = v.Change(t.spark, root)
    change.merge("dim_customer", _customer_changes(t).select("*", bucket), ["id"])
    change.commit()
    return v.read(t.spark, root, "dim_customer").drop("bucket")


@query(
    "q10_repeated_change",
    """select c_custkey as id, case when c_custkey % 3 = 0 then 'second' else c_name end as name,
              case when c_custkey % 3 = 0 then 2 else 0 end as version from customer""",
)
def q10_repeated(t: Tables):
    """Two changes for one key: the later one counts, and the key has one row."""
    key = c("c_custkey")
    stored = t.customer.select(key.alias("id"), c("c_name").alias("name"), F.lit(0).alias("version"))
    target = m.replace_table(stored, m.unique_name("dim_customer"))
    hit = t.customer.where(key % 3 == 0)
    first, second = (hit.select(key.alias("id"), F.lit(n).alias("name"), F.lit(v).alias("version")) for n, v in (("first", 1), ("second", 2)))
    return m.upsert(target, first.unionByName(second), ["id"], -c("version"))


@query(
    "q18_first_success",
    r"""select page_id % 50 as product_id, coalesce(min(url) filter (page_id % 4 = 1), min(url) filter (page_id % 4 = 2), min(url)) as url,
          case when count(*) filter (page_id % 4 = 1) > 0 then 'aiohttp' when count(*) filter (page_id % 4 = 2) > 0 then 'playwright' else 'none' end as method,
          case when count(*) filter (page_id % 4 = 1) > 0 then '200' when count(*) filter (page_id % 4 = 2) > 0 then 'playwright_success' else 'total_fail' end as status_code
        from pages group by 1""",
)
def q18(t: Tables):
    """Crawl attempts on stored pages: plain requests are tried before the browser."""
    key = c("page_id")
    method = F.when(key % 2 == 1, "aiohttp").otherwise("playwright")
    good = (key % 4 == 1) | (key % 4 == 2)
    status = F.when(key % 4 == 1, "200").when(key % 4 == 2, "playwright_success").otherwise("error")
    attempts = t.pages.select(
        (key % 50).alias("product_id"),
        "url",
        F.when(good, text.element_text(c("html"), "h1")).otherwise("fail").alias("name"),
        text.element_attribute(c("html"), "html", "lang").alias("language_code"),
        status.alias("status_code"),
        method.alias("method"),
    )
    return w.first_success(attempts, "product_id", ["aiohttp", "playwright"]).select(
        "product_id", "url", "method", "status_code"
    )


@query(
    "q18_unknown_method",
    """with tried as (select ps_key as product_id, method, place from (select p_partkey as ps_key, unnest([
              {'method': 'mirror', 'place': 3, 'ok': p_partkey % 2 = 0}, {'method': 'aiohttp', 'place': 1, 'ok': p_partkey % 3 = 0},
              {'method': 'playwright', 'place': 2, 'ok': p_partkey % 5 = 0}]) as a from part), lateral (select a.method as method, a.place as place, a.ok as ok) where ok)
       select p_partkey as product_id, coalesce(arg_min(method, place), 'none') as method from part left join tried on product_id = p_partkey group by 1""",
)
def q18_unknown(t: Tables):
    """A method that is not listed counts only where no listed one succeeded."""
    key = c("p_partkey")
    one = lambda method, divisor: F.struct(F.lit(method).alias("method"), (key % divisor == 0).alias("ok"))
    tried = t.part.select(key.alias("product_id"), F.explode(F.array(one("mirror", 2), one("aiohttp", 3), one("playwright", 5))).alias("a"))
    attempts = tried.select(
        "product_id", F.concat(F.lit("https://shop/"), c("product_id")).alias("url"), F.when(c("a.ok"), "found").otherwise("fail").alias("name"),
        F.lit("en").alias("language_code"), F.lit("200").alias("status_code"), "a.method",
    )
    return w.first_success(attempts, "product_id", ["aiohttp", "playwright"]).select("product_id", "method")


@query(
    "q19_document_load",
    """select p_partkey as id, p_name as name, lower(replace(p_name, ' ', '-')) as url_key, cast(floor(p_retailprice) as bigint) as price from part""",
)
def q19(t: Tables):
    """JSON files that each hold one array of products, read into a typed table."""
    from larkspur.sources.readers import read_json_arrays

    folder = new_folder(t.spark, "products")
    product = F.to_json(
        F.struct(
            c("p_partkey").cast("string").alias("id"), c("p_name").alias("name"),
            F.lower(F.replace("p_name", F.lit(" "), F.lit("-"))).alias("url_key"),
            F.floor("p_retailprice").alias("price"),
        )
    )
    # a file holds the array of at most a thousand products
    arrays = t.part.groupBy(F.floor(c("p_partkey") / 1000).alias("file")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(product), ",\n"), F.lit("]")).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    documents = read_json_arrays(t.spark, folder, "id string, name string, url_key string, price bigint")
    return documents.select(c("id").cast("bigint").alias("id"), "name", "url_key", "price")
