"""Click-stream stand-ins, derived from the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.nested import CLICK_SCHEMA
from larkspur.plans import standins as s
from larkspur.plans.registry import Tables

c = F.col

# A document or message is some hundred times its stored row, and takes up to a millisecond to unfold.
ROWS_PER_TASK = 100_000

# User agents with the browser and system they must be recognised as.
AGENTS = [
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.4472.124 Safari/537.36", "Chrome", "Windows"),
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64; rv:89.0) Gecko/20100101 Firefox/89.0", "Firefox", "Windows"),
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/14.1 Safari/605.1.15", "Safari", "macOS"),
    ("Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0 Safari/537.36 Edg/91.0", "Edge", "Windows"),
    ("Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0 Safari/537.36 OPR/77.0", "Opera", "Linux"),
    ("Mozilla/5.0 (Windows NT 6.1; Trident/7.0; rv:11.0) like Gecko", "Internet Explorer", "Windows"),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 13_4_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/13.1 Mobile/15E148 Safari/604.1", "Safari", "macOS"),
    ("Mozilla/5.0 (Linux; Android 10) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0 Mobile Safari/537.36", "Chrome", "Linux"),
    ("curl/7.64", "Other", "Other"),
    (None, None, None),
]
# Referrers with the domain they must give.
REFERRERS = [
    ("https://www.google.com/search?q=ring", "www.google.com"),
    ("facebook.com", "facebook.com"),
    ("https://www.shop.de:8443/a?b#c", "www.shop.de:8443"),
    ("", None),
    (None, None),
    ("not//a-url", None),
    ("//cdn.example.org/x", "cdn.example.org"),
]
SUFFIXES = ["com", "de", "fr", "co.uk", "ro"]
COLLECTIONS = {
    "view": "view_product_detail",
    "click": "select_product_option",
    "purchase": "checkout_success",
    "signup": "view_home_page",
    "error": "add_to_cart_action",
}


def _case(key: str, values) -> str:
    arms = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values) if v is not None)
    return f"case {key} % {len(values)} {arms} end"


def _map(key: str, values: dict) -> str:
    return f"case {key} " + " ".join(f"when '{k}' then '{v}'" for k, v in values.items()) + " end"


s.CTE["clicks"] = f"""
select event_id, ts, user_id,
  case when event_id % 50 <> 7 then 'e' || (case when event_id % 10 = 1 then event_id - 1 else event_id end) end as id,
  cast(floor(epoch(ts)) as bigint) as time_stamp,
  case when event_id % 37 <> 0 then concat_ws('.', user_id % 223 + 1, user_id % 256, event_id % 16, event_id % 8) end as ip,
  {_case("user_id", [a for a, _, _ in AGENTS])} as user_agent,
  {_case("user_id", [b for _, b, _ in AGENTS])} as browser, {_case("user_id", [o for _, _, o in AGENTS])} as os,
  case when event_id % 2 = 0 then '1920x1080' else '' end as resolution, cast(user_id as varchar) as user_id_db,
  'd' || (user_id % 40) as device_id, '1.0' as api_version, cast(user_id % 20 as varchar) as store_id,
  strftime(ts, '%Y-%m-%d %H:%M:%S') as local_time, case when event_id % 3 = 0 then 'true' else 'false' end as show_recommendation,
  'https://www.shop.' || {_case("user_id", SUFFIXES)} || '/p-' || json_extract_string(props, '$.k') || '.html?alloy=white' as current_url,
  {_case("event_id", [r for r, _ in REFERRERS])} as referrer_url, {_case("event_id", [d for _, d in REFERRERS])} as referrer_domain,
  {_case("user_id", SUFFIXES)} as suffix,
  case when event_id % 4 = 0 then '' else 'u' || user_id || '@example.com' end as email_address,
  case when event_id % 5 = 0 then 'false' end as recommendation,
  case event_id % 3 when 0 then 'google' when 1 then '' end as utm_source, case event_id % 3 when 0 then 'cpc' when 1 then '' end as utm_medium,
  {_map("event_type", COLLECTIONS)} as collection,
  case when event_id % 10 > 1 then json_extract_string(props, '$.k') end as product_id,
  '[{{"option_label":"alloy","value_label":"' || (event_id % 6) || '"}},{{"option_label":"diamond","value_label":"' || (case when event_id % 2 = 0 then '' else 'vs' end) || '"}}]' as option,
  case when event_id % 101 = 100 then 'null' when event_id % 97 = 96 then 'cut' else 'ok' end as shape
from events"""


def clicks(t: Tables, events: DataFrame | None = None) -> DataFrame:
    """The typed message fields, with repeated, missing and blank keys. Works on a stream, too."""
    if events is None:
        events = t.spread("events", "event_id", "ts", "user_id", "event_type", "props", most=ROWS_PER_TASK)
    n, user = c("event_id"), c("user_id")
    product = F.get_json_object("props", "$.k")

    def text(column):
        return column.cast("string")

    option = F.array(
        F.create_map(F.lit("option_label"), F.lit("alloy"), F.lit("value_label"), text(n % 6)),
        F.create_map(
            F.lit("option_label"), F.lit("diamond"), F.lit("value_label"), F.when(n % 2 == 0, "").otherwise("vs")
        ),
    )
    collection = F.lit(None)
    for kind, name in COLLECTIONS.items():
        collection = F.when(c("event_type") == kind, name).otherwise(collection)
    ip = F.concat_ws(".", text(user % 223 + 1), text(user % 256), text(n % 16), text(n % 8))
    id_ = F.concat(F.lit("e"), text(F.when(n % 10 == 1, n - 1).otherwise(n)))
    return events.select(
        "event_id",
        c("ts").cast("timestamp").alias("ts"),
        "user_id",
        F.concat(F.lit("m"), text(n)).alias("_id"),
        F.unix_timestamp(c("ts").cast("timestamp")).alias("time_stamp"),
        F.when(n % 37 != 0, ip).alias("ip"),
        s.pick(user, *[a for a, _, _ in AGENTS]).alias("user_agent"),
        F.when(n % 2 == 0, "1920x1080").otherwise("").alias("resolution"),
        text(user).alias("user_id_db"),
        F.concat(F.lit("d"), text(user % 40)).alias("device_id"),
        F.lit("1.0").alias("api_version"),
        text(user % 20).alias("store_id"),
        F.date_format(c("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("local_time"),
        F.when(n % 3 == 0, "true").otherwise("false").alias("show_recommendation"),
        F.concat(
            F.lit("https://www.shop."), s.pick(user, *SUFFIXES), F.lit("/p-"), product, F.lit(".html?alloy=white")
        ).alias("current_url"),
        s.pick(n, *[r for r, _ in REFERRERS]).alias("referrer_url"),
        F.when(n % 4 == 0, "").otherwise(F.concat(F.lit("u"), text(user), F.lit("@example.com"))).alias("email_address"),
        F.when(n % 5 == 0, "false").alias("recommendation"),
        s.pick(n, "google", "", None).alias("utm_source"),
        s.pick(n, "cpc", "", None).alias("utm_medium"),
        collection.alias("collection"),
        F.when(n % 10 > 1, product).alias("product_id"),
        option.alias("option"),
        F.when(n % 50 != 7, id_).alias("id"),
    )


def messages(t: Tables, events: DataFrame | None = None) -> DataFrame:
    """Broker records: the fields as JSON text in ``value``; a few are missing or cut off."""
    fields = clicks(t, events)
    json = F.to_json(F.struct(*[f.name for f in CLICK_SCHEMA.fields]))
    n = c("event_id")
    value = F.when(n % 101 == 100, None).when(n % 97 == 96, F.substring(json, 1, 40)).otherwise(json)
    return fields.select(
        c("user_id").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("product_view").alias("topic"),
        (c("user_id") % 3).cast("int").alias("partition"),
        n.alias("offset"),
        c("ts").alias("timestamp"),
    )


_READ = (
    "id time_stamp ip user_agent browser os resolution user_id_db device_id api_version store_id local_time "
    "show_recommendation current_url referrer_domain suffix email_address recommendation utm_source utm_medium "
    "collection product_id option"
).split()

# What parsing the messages must give: all columns NULL where the value is missing or cut off.
s.CTE["parsed"] = "select event_id, ts, user_id, shape, " + ", ".join(
    f"case when shape = 'ok' then {x} end as {x}" for x in _READ
) + " from clicks"

s.CTE["drift"] = """
select event_id, event_type as collection,
  '{"collection":"' || event_type || '","order_id":' || (case when event_id % 2 = 0 then cast(event_id as varchar) else '""' end)
  || (case event_id % 4 when 0 then ',"show_recommendation":true' when 1 then ',"show_recommendation":"true"' when 2 then ',"show_recommendation":null' else '' end)
  || ',"price":' || (case event_id % 3 when 0 then cast(event_id as varchar) when 1 then event_id || '.5' else '"1,' || event_id || '"' end)
  || ',"option":' || (case event_id % 4 when 0 then '""' when 1 then '{"option_label":"alloy","value_label":"white"}'
       when 2 then '[{"option_label":"alloy","value_label":""},{"option_label":"stone","value_label":"ruby"}]' else 'null' end)
  || ',"cart_products":[{"product_id":' || event_id || ',"amount":2,"option":' || (case event_id % 3 when 0 then '""'
       when 1 then '{"option_label":"size","value_label":"7"}' else '[]' end) || '}]}' as doc
from events"""


def drift(t: Tables) -> DataFrame:
    """Documents whose fields change type: blanks, objects or arrays for options, text or numbers for prices."""
    n = c("event_id")
    word = n.cast("string")
    parts = [
        F.lit('{"collection":"'), c("event_type"), F.lit('","order_id":'), F.when(n % 2 == 0, word).otherwise('""'),
        s.pick(n, ',"show_recommendation":true', ',"show_recommendation":"true"', ',"show_recommendation":null', ""),
        F.lit(',"price":'),
        s.pick(n, word, F.concat(word, F.lit(".5")), F.concat(F.lit('"1,'), word, F.lit('"'))),
        F.lit(',"option":'),
        s.pick(
            n, '""', '{"option_label":"alloy","value_label":"white"}',
            '[{"option_label":"alloy","value_label":""},{"option_label":"stone","value_label":"ruby"}]', "null",
        ),
        F.lit(',"cart_products":[{"product_id":'), word, F.lit(',"amount":2,"option":'),
        s.pick(n, '""', '{"option_label":"size","value_label":"7"}', "[]"), F.lit("}]}"),
    ]
    return t.spread("events", "event_id", "event_type", most=ROWS_PER_TASK).select(
        "event_id", c("event_type").alias("collection"), F.concat(*parts).alias("doc")
    )


s.CTE["carts"] = """
select l_orderkey as _id, concat_ws('.', l_suppkey % 223 + 1, l_suppkey % 256, 0, 1) as ip,
  cast(floor(epoch(l_shipdate)) as bigint) as time_stamp, case when l_returnflag = 'A' then 'checkout_success' else 'checkout' end as collection,
  case when l_linenumber < 7 or l_linestatus = 'O' then 1 else 0 end as has_items,
  case when l_partkey % 31 <> 0 then l_partkey end as p1, l_partkey + 1 as p2,
  case l_linenumber when 1 then replace(format('{:,.2f}', l_extendedprice), ',', '''')
    when 2 then replace(replace(replace(format('{:,.2f}', l_extendedprice), ',', '_'), '.', ','), '_', '.')
    when 3 then format('{:,.2f}', l_extendedprice) when 4 then replace(format('{:.2f}', l_extendedprice), '.', ',')
    when 5 then format('{:.2f}', l_extendedprice) when 6 then '١٢٣٫٥' end as price1,
  case when l_linenumber <= 4 then l_extendedprice when l_linenumber = 5 then l_extendedprice end as value1,
  '10.00' as price2, case l_suppkey % 6 when 0 then '€' when 1 then '$' when 2 then 'CHF' when 3 then '??' when 4 then '' else 'kr' end as currency,
  cast(l_quantity as bigint) as amount1, case when l_quantity > 5 then 2 end as amount2
from lineitem"""


def carts(t: Tables) -> DataFrame:
    """Check-out documents with an array of two products, or an empty one. Prices come in local styles."""
    price = c("l_extendedprice")
    grouped = F.format_number(price, 2)
    plain = F.replace(grouped, F.lit(","), F.lit(""))
    styles = [
        F.translate(grouped, ",", "'"),
        F.translate(grouped, ",.", ".,"),
        grouped,
        F.translate(plain, ".", ","),
        plain,
        F.lit("١٢٣٫٥"),
    ]
    text = F.lit(None).cast("string")
    for i, style in enumerate(styles, start=1):
        text = F.when(c("l_linenumber") == i, style).otherwise(text)
    currency = s.pick(c("l_suppkey"), "€", "$", "CHF", "??", "", "kr")

    def product(key, amount, price_text):
        return F.struct(
            key.alias("product_id"), amount.cast("bigint").alias("amount"), price_text.alias("price"),
            currency.alias("currency"),
        )

    first = product(F.when(c("l_partkey") % 31 != 0, c("l_partkey")), c("l_quantity"), text)
    second = product(c("l_partkey") + 1, F.when(c("l_quantity") > 5, 2), F.lit("10.00"))
    filled = (c("l_linenumber") < 7) | (c("l_linestatus") == "O")
    items = F.array(first, second)
    columns = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_returnflag l_linestatus l_shipdate"
    return t.spread("lineitem", *columns.split()).select(
        c("l_orderkey").alias("_id"),
        F.concat_ws(".", (c("l_suppkey") % 223 + 1).cast("string"), (c("l_suppkey") % 256).cast("string"), F.lit("0"), F.lit("1")).alias("ip"),
        F.unix_timestamp(c("l_shipdate").cast("timestamp")).alias("time_stamp"),
        F.when(c("l_returnflag") == "A", "checkout_success").otherwise("checkout").alias("collection"),
        F.when(filled, items).otherwise(F.filter(items, lambda x: F.lit(False))).alias("cart_products"),
    )


# One row per cart product, in SQL.
s.CTE["items"] = """
select _id, ip, time_stamp, collection, p1 as product_id, amount1 as amount, price1 as price, value1 as value, currency from carts where has_items = 1
union all select _id, ip, time_stamp, collection, p2, amount2, price2, 10.0::double, currency from carts where has_items = 1"""
