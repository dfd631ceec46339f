"""Scalar function queries: text, dates, numbers, keys and the Python function surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions import dates, keys, money, text, udfs, web
from larkspur.plans import standins as s
from larkspur.plans.clicks import carts, clicks
from larkspur.plans.joins import jobs
from larkspur.plans.registry import Tables, query

c = F.col


@query(
    "c01_basic_text",
    """select p_partkey, lower(p_brand) as brand, trim('  ' || p_name || ' ') as name, replace(p_name, ' ', '-') as slug,
              p_brand || '/' || p_type as path, split_part(p_name, ' ', 2) as noun from part""",
)
def c01(t: Tables):
    return t.part.select(
        "p_partkey",
        F.lower("p_brand").alias("brand"),
        F.trim(F.concat(F.lit("  "), c("p_name"), F.lit(" "))).alias("name"),
        F.replace("p_name", F.lit(" "), F.lit("-")).alias("slug"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("path"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("noun"),
    )


@query(
    "c02_split_to_array",
    s.with_("films") + """select id, cast(len(string_split("cast", '|')) as integer) as n, string_split("cast", '|')[1] as first from films""",
)
def c02(t: Tables):
    names = F.split("cast", r"\|")
    return s.films(t).select("id", F.size(names).alias("n"), F.get(names, 0).alias("first"))


@query(
    "c03_regex",
    s.with_("jobs")
    + r"""select id, regexp_extract(lower(salary), '(\d+)\s*-\s*(\d+)', 1) as low, regexp_extract(lower(salary), '(\d+)\s*-\s*(\d+)', 2) as high,
          regexp_matches(salary, '(?i)usd$') as in_dollars from jobs""",
)
def c03(t: Tables):
    pair = r"(\d+)\s*-\s*(\d+)"
    lowered = F.lower("salary")
    return jobs(t).select(
        "id",
        F.regexp_extract(lowered, pair, 1).alias("low"),
        F.regexp_extract(lowered, pair, 2).alias("high"),
        c("salary").rlike("(?i)usd$").alias("in_dollars"),
    )


@query(
    "c04_name_tokens",
    s.with_("films")
    + """select id, token from (select id, unnest(string_split(replace(replace("cast", ' ', '_'), '"', ''), '|')) as token from films) where token <> ''""",
)
def c04(t: Tables):
    return s.films(t).select("id", F.explode(text.split_tokens(c("cast"))).alias("token"))


@query(
    "c05_accent_folding",
    """select doc_id, replace(replace(replace(replace(strip_accents(lower(text)), 'đ', 'd'), 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe') as folded from documents""",
)
def c05(t: Tables):
    return t.spread("documents", "doc_id", "text").select("doc_id", text.fold_accents(c("text")).alias("folded"))


def _category_sql() -> str:
    folded = "replace(strip_accents(lower(job_title)), 'đ', 'd')"
    arms = " ".join(
        f"when regexp_matches({folded}, '{'|'.join(words)}') then '{name}'" for name, words in text.JOB_CATEGORIES.items()
    )
    return f"case {arms} else 'Other' end"


@query("c06_keyword_category", s.with_("jobs") + f"select id, {_category_sql()} as category from jobs")
def c06(t: Tables):
    return jobs(t).select("id", text.job_category(c("job_title")).alias("category"))


@query(
    "c07_salary_text",
    s.with_("jobs")
    + """, a as (select id, replace(lower(salary), ',', '') as x from jobs),
         b as (select id, x, regexp_extract(x, '(\\d+)', 1) as f, regexp_extract(x, '(\\d+)\\s*-\\s*(\\d+)', 1) as lo,
                      regexp_extract(x, '(\\d+)\\s*-\\s*(\\d+)', 2) as hi from a)
         select id, contains(x, 'thoả thuận') as negotiable,
                cast(nullif(case when contains(x, 'trên') then f else lo end, '') as double) as salary_min,
                cast(nullif(case when contains(x, 'tới') then f else hi end, '') as double) as salary_max,
                case when contains(x, 'usd') then 'USD' else 'M VND' end as salary_unit from b""",
)
def c07(t: Tables):
    return jobs(t).select("id", *[v.alias(k) for k, v in money.salary_columns(c("salary")).items()])


@query(
    "c08_gender_label",
    s.with_("survey")
    + """select id, case when lower("Gender") in ('m', 'male', 'man') then 'Male' when lower("Gender") in ('f', 'female', 'woman') then 'Female'
         else 'Unknown' end as gender from survey""",
)
def c08(t: Tables):
    return s.survey(t).select("id", text.gender_label(c("Gender")).alias("gender"))


s.CTE["heads"] = """
select id, no_employees, cast(case no_employees when '1-5' then 1 when '26-100' then 26 when '500-1000' then 500 when 'More than 1000' then 1001 when '5' then 5 end as integer) as low,
       cast(case no_employees when '1-5' then 5 when '26-100' then 100 when '500-1000' then 1000 when '5' then 5 end as integer) as high from survey"""


@query("c09_head_count", s.with_("survey", "heads") + "select id, low, high from heads")
def c09(t: Tables):
    return s.survey(t).select("id", text.head_count(c("no_employees")).alias("n")).select("id", "n.low", "n.high")


def _prices(t: Tables):
    """The price texts of all items of all carts."""
    return carts(t).select("_id", F.explode("cart_products.price").alias("price"))


@query(
    "c10_locale_price",
    s.with_("carts", "items") + "select _id, price, value from items",
)
def c10(t: Tables):
    return _prices(t).select("_id", "price", money.locale_price(c("price")).alias("value"))


@query(
    "c11_loose_number",
    s.with_("carts", "items")
    + r"""select _id, price, case when price = '١٢٣٫٥' then 1235.0 else
            try_cast(case when length(k) - length(replace(k, '.', '')) > 1 then
               replace(left(k, length(k) - position('.' in reverse(k))), '.', '') || '.' || right(k, position('.' in reverse(k)) - 1) else k end as double) end as value
          from (select *, regexp_replace(price, '[^0-9.]', '', 'g') as k from items)""",
)
def c11(t: Tables):
    return _prices(t).select("_id", "price", money.loose_number(c("price")).alias("value"))


@query(
    "c12_prefixed_money",
    s.with_("movie")
    + """select id, cast(case split_part(worldwide_gross_income, ' ', 1)
           when 'INR' then cast(round(cast(split_part(worldwide_gross_income, ' ', 2) as decimal(18,2)) * 0.012, 2) as decimal(18,2))
           when '$' then cast(split_part(worldwide_gross_income, ' ', 2) as decimal(18,2)) end as double) as income from movie""",
)
def c12(t: Tables):
    income = money.prefixed_amount(c("worldwide_gross_income"), money.INCOME_RATES)
    return s.movie(t).select("id", income.cast("double").alias("income"))


s.CTE["rosters"] = """
select c_custkey as id, (4 + c_custkey % 4) || '-' || (c_custkey % 12) as height, cast((4 + c_custkey % 4) * 12 + c_custkey % 12 as integer) as inches,
  case when c_custkey % 3 = 0 then c_name else c_name || ', ' || c_mktsegment end as hometown, '  ' || c_name || ' ' as name,
  case when c_custkey % 3 = 0 then c_name else c_mktsegment end as state from customer"""


def rosters(t: Tables):
    key = c("c_custkey")
    height = F.concat((key % 4 + 4).cast("string"), F.lit("-"), (key % 12).cast("string"))
    town = F.when(key % 3 == 0, c("c_name")).otherwise(F.concat("c_name", F.lit(", "), "c_mktsegment"))
    return t.customer.select(
        key.alias("id"), height.alias("height"), town.alias("hometown"),
        F.concat(F.lit("  "), c("c_name"), F.lit(" ")).alias("name"),
    )


@query("c13_height_inches", s.with_("rosters") + "select id, inches from rosters")
def c13(t: Tables):
    return rosters(t).select("id", text.height_inches(c("height")).alias("inches"))


@query("c14_region_part", s.with_("rosters") + "select id, state from rosters")
def c14(t: Tables):
    return rosters(t).select("id", text.region_part(c("hometown")).alias("state"))


@query("c15_strip_columns", s.with_("rosters") + "select id, height, trim(name) as name, hometown from rosters")
def c15(t: Tables):
    return text.trim_columns(rosters(t), ["name", "hometown"])


_HTML_SQL = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
   '(?is)<script\b[^>]*>.*?</script\s*>', '', 'g'), '(?is)<style\b[^>]*>.*?</style\s*>', '', 'g'), '<[^>]*>', '', 'g')"""


def _unescape(sql: str) -> str:
    for name, sign in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        sql = f"regexp_replace({sql}, '&{name};?', '{sign}', 'g')"
    return sql


@query(
    "c16_html_to_text",
    r"select page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower("
    + _unescape(_HTML_SQL)
    + r"""), '[\r\t\n]', ' ', 'g'), '\.{2,}', ' ', 'g'), '[{};():,."/<>-]', ' ', 'g'), '\s{2,}', ' ', 'g')) as text from pages""",
)
def c16(t: Tables):
    return t.spread("pages", "page_id", "html").select("page_id", text.clean_html(c("html")).alias("text"))


@query(
    "c17_element_extraction",
    r"select page_id, coalesce(nullif(trim("
    + _unescape(r"regexp_replace(regexp_extract(html, '(?is)<h1\b[^>]*>(.*?)</h1\s*>', 1), '<[^>]*>', '', 'g')")
    + r"""), ''), 'fail') as name, nullif(regexp_extract(html, '(?is)<html\b[^>]*\slang="([^"]*)"', 1), '') as language_code,
          'fail' as product_name from pages""",
)
def c17(t: Tables):
    """Heading and page language; the pages have no product span, so that one fails throughout."""
    return t.pages.select(
        "page_id",
        text.element_text(c("html"), "h1").alias("name"),
        text.element_attribute(c("html"), "html", "lang").alias("language_code"),
        text.element_text(c("html"), "span", "base").alias("product_name"),
    )


@query(
    "c18_link_rows",
    """select p_partkey, p_name as label, 'https://shop.example/' || p_partkey as url from part
       union all select p_partkey, p_type, 'https://shop.example/t/' || p_type from part""",
)
def c18(t: Tables):
    markdown = F.concat(
        F.lit("* ["), c("p_name"), F.lit("](https://shop.example/"), c("p_partkey").cast("string"), F.lit(' "title")\n* [other](http://else.example/1 "x")\n['),
        c("p_type"), F.lit("](https://shop.example/t/"), c("p_type"), F.lit(" )"),
    )
    return (
        t.part.select("p_partkey", F.explode(text.markdown_links(markdown, "https://shop.example/")).alias("link"))
        .select("p_partkey", "link.label", "link.url")
    )


@query(
    "c19_canonical_page",
    s.with_("clicks")
    + """select distinct product_id, split_part(current_url, '?', 1) as current_url from clicks
         where product_id is not null and collection in ('view_product_detail', 'select_product_option', 'select_product_option_quality')
         and current_url like 'https://www.shop.%' and contains(current_url, '.html')""",
)
def c19(t: Tables):
    viewed = c("collection").isin("view_product_detail", "select_product_option", "select_product_option_quality")
    return (
        clicks(t)
        .where(viewed & web.is_product_page(c("current_url"), "https://www.shop."))
        .na.drop(subset=["product_id", "current_url"])
        .select("product_id", web.canonical_page(c("current_url")).alias("current_url"))
        .distinct()
    )


@query("c20_referrer_domain", s.with_("clicks") + "select event_id, referrer_domain as domain from clicks")
def c20(t: Tables):
    return clicks(t).select("event_id", web.authority(c("referrer_url")).alias("domain"))


@query("c21_browser", s.with_("clicks") + "select event_id, browser from clicks")
def c21(t: Tables):
    return clicks(t).select("event_id", web.browser(c("user_agent")).alias("browser"))


@query("c22_operating_system", s.with_("clicks") + "select event_id, os from clicks")
def c22(t: Tables):
    return clicks(t).select("event_id", web.operating_system(c("user_agent")).alias("os"))


@query(
    "c23_label_join",
    """select p_partkey, upper(left(split_part(p_name, ' ', 1), 1)) || substr(split_part(p_name, ' ', 1), 2) || '_' ||
              upper(left(split_part(p_name, ' ', 2), 1)) || substr(split_part(p_name, ' ', 2), 2) as label from part""",
)
def c23(t: Tables):
    return t.part.select("p_partkey", text.join_words(F.upper("p_name")).alias("label"))


# --- dates -----------------------------------------------------------------------


@query(
    "d01_parse_by_pattern",
    s.with_("invoices", "flights1")
    + """select 'invoice' as source, cast(count(strptime("InvoiceDate", '%d-%m-%Y %-H.%M')) as bigint) as parsed, strftime(max(invoice_day), '%Y-%m-%d') as latest from invoices
         union all select 'flight', cast(count(strptime("FL_DATE", '%m/%d/%Y')) as bigint), strftime(max(strptime("FL_DATE", '%m/%d/%Y')), '%Y-%m-%d') from flights1""",
)
def d01(t: Tables):
    def summary(df, source, text_column, pattern):
        moment = F.try_to_timestamp(text_column, F.lit(pattern))
        return df.agg(F.count(moment).alias("parsed"), F.date_format(F.max(moment), "yyyy-MM-dd").alias("latest")).select(
            F.lit(source).alias("source"), "parsed", "latest"
        )

    invoices = summary(s.invoices(t), "invoice", "InvoiceDate", "dd-MM-yyyy H.mm")
    return invoices.unionByName(summary(s.flights1(t), "flight", "FL_DATE", "M/d/yyyy"))


@query("d02_year_month", "select o_orderkey, cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month from orders")
def d02(t: Tables):
    return t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


def _pivot_sql(name: str, pivot: int) -> str:
    from larkspur.plans.windows import _pivot_date_sql

    return f"strftime({_pivot_date_sql(pivot)}, '%Y-%m-%d') as {name}"


@query(
    "d03_two_digit_years",
    s.with_("films") + f"select id, {_pivot_sql('shell', 31)}, {_pivot_sql('notebook', 30)} from films",
)
def d03(t: Tables):
    def iso(pivot):
        return F.date_format(dates.two_digit_year_date(c("release_date"), pivot), "yyyy-MM-dd")

    return s.films(t).select("id", iso(dates.SHELL_PIVOT).alias("shell"), iso(dates.NOTEBOOK_PIVOT).alias("notebook"))


@query(
    "d04_epoch_text",
    "select event_id, strftime(ts, '%Y-%m-%d') as full_date, strftime(ts, '%H:%M:%S') as full_time from events",
)
def d04(t: Tables):
    seconds = F.unix_timestamp(c("ts").cast("timestamp"))
    return t.events.select("event_id", *[v.alias(k) for k, v in dates.epoch_columns(seconds).items()])


def _order_days(t: Tables):
    bounds = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last"))
    return dates.calendar(bounds, "first", "last")


s.CTE["days"] = """select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as d from
  (select cast(cast(min(o_orderdate) as date) as timestamp) as lo, cast(cast(max(o_orderdate) as date) as timestamp) as hi from orders)"""


@query("d05_calendar", s.with_("days") + "select strftime(d, '%Y-%m-%d') as full_date from days")
def d05(t: Tables):
    return _order_days(t).select(F.date_format("full_date", "yyyy-MM-dd").alias("full_date"))


@query(
    "d06_sunday_week_calendar",
    s.with_("days")
    + """select strftime(d, '%Y-%m-%d') as full_date, dayname(d) as day_of_week, left(dayname(d), 3) as day_of_week_short,
         case when dayofweek(d) in (0, 6) then 'Weekend' else 'Weekday' end as is_weekday_or_weekend, cast(day(d) as integer) as day_of_month,
         strftime(d, '%Y-%m') as year_month, cast(month(d) as integer) as month, cast(dayofyear(d) as integer) as day_of_year,
         cast(strftime(d, '%U') as integer) as week_of_year, cast(quarter(d) as integer) as quarter_number, cast(year(d) as integer) as year_number from days""",
)
def d06(t: Tables):
    days = dates.sunday_week_attributes(_order_days(t))
    return days.withColumn("full_date", F.date_format("full_date", "yyyy-MM-dd"))


@query(
    "d07_iso_week_calendar",
    s.with_("days")
    + """select strftime(d, '%Y-%m-%d') as full_date, cast(isodow(d) as integer) as day_of_week, left(dayname(d), 3) as day_of_week_short,
         case when isodow(d) > 5 then 'Weekend' else 'Weekday' end as is_weekday_or_weekend, cast(day(d) as integer) as day_of_month,
         strftime(d, '%Y-%m') as year_month, cast(month(d) as integer) as month, cast(dayofyear(d) as integer) as day_of_year,
         cast(weekofyear(d) as integer) as week_of_year, cast(quarter(d) as integer) as quarter_number, cast(year(d) as integer) as year from days""",
)
def d07(t: Tables):
    return dates.iso_week_attributes(_order_days(t))


# --- numbers and keys --------------------------------------------------------------


@query(
    "m01_rounding",
    """select o_orderkey, round(o_totalprice / 7, 2) as seventh, o_orderkey % 2 as parity, cast(trunc(o_totalprice) as bigint) as whole,
              round(o_totalprice / 1000 * 100, 4) as percent from orders""",
)
def m01(t: Tables):
    price = c("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        F.round(price / 7, 2).alias("seventh"),
        (c("o_orderkey") % 2).alias("parity"),
        price.cast("bigint").alias("whole"),
        F.round(price / 1000 * 100, 4).alias("percent"),
    )


@query(
    "m02_sha_keys",
    s.with_("clicks")
    + """select event_id, case when id is not null then sha256(id || coalesce(product_id, '')) end as sales_key,
         case when ip is not null then sha256(ip) end as ip_key, case when user_agent is not null then sha256(user_agent) end as user_agent_key from clicks""",
)
def m02(t: Tables):
    return clicks(t).select(
        "event_id",
        keys.sales_key(c("id"), c("product_id")).alias("sales_key"),
        keys.sha_key(c("ip")).alias("ip_key"),
        keys.sha_key(c("user_agent")).alias("user_agent_key"),
    )


@query(
    "m03_fingerprint",
    """select count(*) as rows, count(distinct l_orderkey || '|' || l_partkey) as pairs, count(distinct l_orderkey || '|' || l_partkey) as keys,
              cast(1 as bigint) as keys_per_pair from lineitem""",
)
def m03(t: Tables):
    """The key values differ between engines, so the check counts them: one key per pair, none shared."""
    pairs = t.lineitem.select(
        "l_orderkey", "l_partkey", keys.fingerprint(c("l_orderkey"), F.lit("|"), c("l_partkey")).alias("key")
    )
    per_pair = pairs.groupBy("l_orderkey", "l_partkey").agg(
        F.count("*").alias("n"), F.count_distinct("key").alias("k"), F.min("key").alias("key")
    )
    return per_pair.agg(
        F.sum("n").alias("rows"),
        F.count("*").alias("pairs"),
        F.count_distinct("key").alias("keys"),
        F.max("k").alias("keys_per_pair"),
    )


# --- Python functions --------------------------------------------------------------


@query(
    "f01_python_function",
    s.with_("survey")
    + """select "Country", case when lower("Gender") in ('m', 'male', 'man') then 'Male' when lower("Gender") in ('f', 'female', 'woman') then 'Female'
         else 'Unknown' end as gender, count(*) as n from survey group by 1, 2""",
)
def f01(t: Tables):
    return s.survey(t).groupBy("Country", udfs.gender_udf("Gender").alias("gender")).agg(F.count("*").alias("n"))


@query(
    "f02_registered_function",
    s.with_("survey")
    + """select case when lower("Gender") in ('m', 'male', 'man') then 'Male' when lower("Gender") in ('f', 'female', 'woman') then 'Female'
         else 'Unknown' end as gender, count(*) as n, true as listed from survey group by 1""",
)
def f02(t: Tables):
    name = udfs.register_gender(t.spark)
    listed = any(f.name == name for f in t.spark.catalog.listFunctions(pattern=name))
    return s.survey(t).groupBy(F.expr(f"{name}(Gender)").alias("gender")).agg(F.count("*").alias("n"), F.lit(listed).alias("listed"))


@query("f03_struct_function", s.with_("survey", "heads") + "select id, low, high from heads where low >= 500")
def f03(t: Tables):
    counted = s.survey(t).select("id", udfs.employees_udf("no_employees").alias("no_employees"))
    return counted.where("no_employees.low >= 500").select("id", "no_employees.low", "no_employees.high")


@query("f04_function_by_name", s.with_("clicks") + "select event_id, browser, os, referrer_domain as domain from clicks")
def f04(t: Tables):
    by_name = udfs.column_function
    return clicks(t).select(
        "event_id",
        by_name("extract_browser")(c("user_agent")).alias("browser"),
        by_name("extract_os")(c("user_agent")).alias("os"),
        by_name("extract_referrer_domain")(c("referrer_url")).alias("domain"),
    )
