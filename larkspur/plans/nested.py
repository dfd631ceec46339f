"""JSON, struct, array and map queries, and profiles of loosely typed documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions import nested
from larkspur.operators.aggregates import empty_counts
from larkspur.plans import standins as s
from larkspur.plans.clicks import carts, clicks, drift, messages
from larkspur.plans.registry import Tables, query

c = F.col


@query(
    "n01_json_to_columns",
    s.with_("clicks", "parsed")
    + "select id, time_stamp, ip, user_agent, store_id, email_address, product_id, collection from parsed",
)
def n01(t: Tables):
    """Missing and cut-off values give rows of NULLs."""
    return nested.parse_json(messages(t), "value", nested.CLICK_SCHEMA).select(
        "id", "time_stamp", "ip", "user_agent", "store_id", "email_address", "product_id", "collection"
    )


@query("n02_array_to_json", s.with_("clicks", "parsed") + "select id, option from parsed")
def n02(t: Tables):
    parsed = nested.parse_json(messages(t), "value", nested.CLICK_SCHEMA)
    return parsed.select("id", F.to_json("option").alias("option"))


_USER = "struct<id:bigint,firstName:string,address:struct<country:string,city:string>,age:int>"


@query(
    "n03_flatten_objects",
    """select c_custkey as id, c_name as firstname, n_name as country, cast(floor(abs(c_acctbal)) as integer) as age
       from customer join nation on c_nationkey = n_nationkey union all
       select -c_custkey, c_mktsegment, n_name, cast(1 as integer) from customer join nation on c_nationkey = n_nationkey""",
)
def n03(t: Tables):
    """API pages: {"users": [{..., "address": {"country": ...}}]} to one row per user."""
    address = F.struct(c("n_name").alias("country"), c("c_mktsegment").alias("city"))
    user = F.struct(
        c("c_custkey").alias("id"), c("c_name").alias("firstName"), address.alias("address"),
        F.floor(F.abs("c_acctbal")).cast("int").alias("age"),
    )
    other = F.struct(
        (-c("c_custkey")).alias("id"), c("c_mktsegment").alias("firstName"), address.alias("address"),
        F.lit(1).alias("age"),
    )
    pages = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey")).select(
        F.to_json(F.struct(F.array(user, other).alias("users"))).alias("page")
    )
    users = pages.select(F.explode(F.from_json("page", f"struct<users:array<{_USER}>>").getField("users")).alias("u"))
    return users.select("u.id", c("u.firstName").alias("firstname"), "u.address.country", "u.age")


@query(
    "n04_unnest_array_of_structs",
    s.with_("carts", "items") + "select _id, collection, product_id, amount, price, currency from items",
)
def n04(t: Tables):
    """Rows with an empty array disappear."""
    return carts(t).select("_id", "collection", F.explode("cart_products").alias("cp")).select(
        "_id", "collection", "cp.product_id", "cp.amount", "cp.price", "cp.currency"
    )


@query(
    "n05_struct_fields",
    s.with_("carts") + "select _id, amount1 as amount, currency from carts where has_items = 1 and amount1 >= 40",
)
def n05(t: Tables):
    first = carts(t).select("_id", F.try_element_at("cart_products", F.lit(1)).alias("first"))
    return first.where("first.amount >= 40").select("_id", "first.amount", "first.currency")


_OPTION = "struct<option_label:string,value_label:string>"
_REPAIR = f"struct<collection:string,order_id:string,show_recommendation:string,price:string,option:string,cart_products:array<struct<product_id:bigint,amount:bigint,option:string>>>"


def repaired(t: Tables):
    doc = F.from_json("doc", _REPAIR)
    wide = drift(t).select("event_id", doc.alias("d")).select("event_id", "d.*")
    items = F.transform(
        "cart_products", lambda x: x.withField("option", nested.list_of(x.getField("option"), _OPTION))
    )
    typed = wide.withColumns({"option": nested.list_of(c("option"), _OPTION), "cart_products": items})
    return nested.blank_to_null(typed)


@query(
    "n06_shape_repair",
    """select event_id, event_type as collection, case when event_id % 2 = 0 then cast(event_id as varchar) end as order_id,
              cast(case event_id % 4 when 0 then 0 when 1 then 1 when 2 then 2 end as integer) as options,
              case event_id % 4 when 1 then 'white' when 2 then '' end as first_value,
              cast(case event_id % 3 when 1 then 1 else 0 end as integer) as item_options
       from events""",
)
def n06(t: Tables):
    options = F.when(c("option").isNotNull(), F.size("option"))
    return repaired(t).select(
        "event_id",
        "collection",
        "order_id",
        options.alias("options"),
        F.get("option", 0).getField("value_label").alias("first_value"),
        F.size(F.get("cart_products", 0).getField("option")).alias("item_options"),
    )


@query(
    "n07_schema_from_profile",
    """select * from (values (0, 'cart_products', 'array<struct<amount:bigint,option:string,product_id:bigint>>'), (1, 'collection', 'string'),
         (2, 'option', 'string'), (3, 'order_id', 'string'), (4, 'price', 'string'), (5, 'show_recommendation', 'string'))
       as v(position, field, type) where (select count(*) from events) > 0""",
)
def n07(t: Tables):
    """The nullable schema that fits all documents; mixed types widen to text."""
    schema = nested.target_schema(nested.type_profile(drift(t), "doc", "collection"))
    from larkspur.sources.literal import literal_rows

    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields)]
    return literal_rows(t.spark, rows, "position int, field string, type string")


@query(
    "n08_map_of_lists_rows",
    """select p_partkey, p_type || '_' || p_brand as key_value from part union all
       select p_partkey, p_type || '_' || split_part(p_name, ' ', 1) from part union all select p_partkey, 'Size_' || p_size from part""",
)
def n08(t: Tables):
    first_word = F.split_part("p_name", F.lit(" "), F.lit(1))
    maps = t.part.select(
        "p_partkey",
        F.create_map(c("p_type"), F.array(c("p_brand"), first_word), F.lit("Size"), F.array(c("p_size").cast("string"))).alias("m"),
    )
    return nested.key_value_rows(maps, ["p_partkey"], "m")


@query(
    "a27_type_histogram",
    """select case event_id % 4 when 0 then 'bool' when 1 then 'str' when 2 then 'NoneType' else 'missing' end as type, count(*) as count from events group by 1""",
)
def a27(t: Tables):
    docs = drift(t).select(F.parse_json("doc").alias("v"))
    field = docs.select(F.expr("variant_get(v, '$.show_recommendation', 'variant')").alias("f"))
    kind = F.when(c("f").isNull(), "missing").otherwise(nested.python_type("f"))
    return field.groupBy(kind.alias("type")).agg(F.count("*").alias("count"))


@query(
    "a28_missing_and_empty",
    s.with_("clicks", "parsed")
    + " union all ".join(
        f"""select '{x}' as field, 'missing' as kind, cast(count(*) filter ({x} is null) as bigint) as n from parsed
            union all select '{x}', 'empty', cast(count(*) filter ({x} = '') as bigint) from parsed"""
        for x in ("email_address", "product_id", "utm_source")
    ),
)
def a28(t: Tables):
    parsed = nested.parse_json(messages(t), "value", nested.CLICK_SCHEMA)
    return empty_counts(parsed, ["email_address", "product_id", "utm_source"])


@query(
    "a30_unwind_label_counts",
    """select label, count(*) as count, cast(count(*) filter (empty) as bigint) as empty_value_count from (
         select 'alloy' as label, false as empty from events union all select 'diamond', event_id % 2 = 0 from events) group by label""",
)
def a30(t: Tables):
    options = clicks(t).select(F.explode("option").alias("o"))
    return options.groupBy(c("o")["option_label"].alias("label")).agg(
        F.count("*").alias("count"), F.count_if(c("o")["value_label"] == "").alias("empty_value_count")
    )


_PROFILE_SQL = """
select event_type as label, path, type, count(*) as n from (
  select event_id, event_type, 'collection' as path, 'str' as type from events
  union all select event_id, event_type, 'order_id', case when event_id % 2 = 0 then 'int' else 'str' end from events
  union all select event_id, event_type, 'show_recommendation', case event_id % 4 when 0 then 'bool' when 1 then 'str' else 'NoneType' end from events where event_id % 4 <> 3
  union all select event_id, event_type, 'price', case event_id % 3 when 0 then 'int' when 1 then 'float' else 'str' end from events
  union all select event_id, event_type, 'option', case event_id % 4 when 0 then 'str' when 1 then 'dict' when 2 then 'list' else 'NoneType' end from events
  union all select event_id, event_type, p, 'str' from events, (values ('option.option_label'), ('option.value_label')) v(p) where event_id % 4 in (1, 2)
  union all select event_id, event_type, p, 'str' from events, (values ('option.option_label'), ('option.value_label')) v(p) where event_id % 4 = 2
  union all select event_id, event_type, 'cart_products', 'list' from events
  union all select event_id, event_type, p, 'int' from events, (values ('cart_products.product_id'), ('cart_products.amount')) v(p)
  union all select event_id, event_type, 'cart_products.option', case event_id % 3 when 0 then 'str' when 1 then 'dict' else 'list' end from events
  union all select event_id, event_type, p, 'str' from events, (values ('cart_products.option.option_label'), ('cart_products.option.value_label')) v(p) where event_id % 3 = 1
) group by 1, 2, 3"""


@query("a31_type_profile_per_label", _PROFILE_SQL)
def a31(t: Tables):
    return nested.type_profile(drift(t), "doc", "collection")


@query(
    "a31_type_profile_combined",
    f"select path, string_agg(distinct type, ',' order by type) as types from ({_PROFILE_SQL}) group by path",
)
def a31_combined(t: Tables):
    return nested.path_types(nested.type_profile(drift(t), "doc", "collection"))


@query(
    "a31_unreadable",
    """select event_type as label, '' as path, 'unreadable' as type, count(*) as n from events where event_id % 3 = 0 group by 1
       union all select event_type, 'id', 'int', count(*) from events where event_id % 3 > 0 group by 1
       union all select event_type, 'size', 'float', count(*) from events where event_id % 3 = 2 group by 1""",
)
def a31_unreadable(t: Tables):
    """Documents cut off in the middle, whole numbers beyond 64 bit, and missing documents."""
    key = c("event_id").cast("string")
    doc = (
        F.when(c("event_id") % 3 == 0, F.concat(F.lit('{"id": '), key))
        .when(c("event_id") % 3 == 1, F.concat(F.lit('{"id": 9999999999999999999999'), key, F.lit("}")))
        .otherwise(F.concat(F.lit('{"id": '), key, F.lit(', "size": 0.5}')))
    )
    given = t.events.select("event_type", doc.alias("doc"))
    missing = t.events.select("event_type", F.lit(None).cast("string").alias("doc"))
    return nested.type_profile(given.unionByName(missing), "doc", "event_type")


@query(
    "n07_schema_of_repaired",
    """select * from (values (0, 'cart_products', 'array<struct<amount:bigint,option:array<struct<option_label:string,value_label:string>>,product_id:bigint>>'),
         (1, 'collection', 'string'), (2, 'option', 'array<struct<option_label:string,value_label:string>>'), (3, 'order_id', 'string'),
         (4, 'price', 'string'), (5, 'show_recommendation', 'string')) as v(position, field, type) where (select count(*) from events) > 0""",
)
def n07_repaired(t: Tables):
    """After the shape repair, options are lists everywhere and keep their element fields."""
    from larkspur.sources.literal import literal_rows

    docs = repaired(t).drop("event_id")
    json = F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"})
    profile = nested.type_profile(docs.select("collection", json.alias("doc")), "doc", "collection")
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(nested.target_schema(profile).fields)]
    return literal_rows(t.spark, rows, "position int, field string, type string")
