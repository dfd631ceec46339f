"""Input frames for the named queries, derived row by row from the given tables.

Every frame has two definitions: a DataFrame function used by the queries, and a
SQL text used by the checks. The texts are independent of the Spark code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.plans.registry import Tables

c = F.col

CTE: dict[str, str] = {}


def with_(*names: str) -> str:
    """A WITH clause that defines the named stand-ins, in the order given."""
    return "with " + ",\n".join(f"{name} as ({CTE[name]})" for name in names)


def pick(key: Column, *choices) -> Column:
    """Choose by remainder: choices[key % len(choices)]; None gives NULL."""
    out = F.lit(choices[-1]) if not isinstance(choices[-1], Column) else choices[-1]
    for i in range(len(choices) - 2, -1, -1):
        value = choices[i] if isinstance(choices[i], Column) else F.lit(choices[i])
        out = F.when(key % len(choices) == i, value).otherwise(out)
    return out


# --- survey -----------------------------------------------------------------

CTE["survey"] = """
select c_custkey as id, n_name as "Country",
       cast(cast(floor(abs(c_acctbal)) as bigint) % 60 + 15 as integer) as "Age",
       case c_mktsegment when 'AUTOMOBILE' then 'Male' when 'BUILDING' then 'F' when 'FURNITURE' then 'm'
            when 'HOUSEHOLD' then 'Woman' else case when c_custkey % 2 = 0 then 'Agender' end end as "Gender",
       case c_custkey % 7 when 0 then '1-5' when 1 then '26-100' when 2 then '500-1000'
            when 3 then 'More than 1000' when 4 then '5' when 5 then 'unknown' end as no_employees
from customer join nation on c_nationkey = n_nationkey
"""


def survey(t: Tables) -> DataFrame:
    gender = (
        F.when(c("c_mktsegment") == "AUTOMOBILE", "Male")
        .when(c("c_mktsegment") == "BUILDING", "F")
        .when(c("c_mktsegment") == "FURNITURE", "m")
        .when(c("c_mktsegment") == "HOUSEHOLD", "Woman")
        .otherwise(F.when(c("c_custkey") % 2 == 0, "Agender"))
    )
    employees = pick(
        c("c_custkey"), "1-5", "26-100", "500-1000", "More than 1000", "5", "unknown", None
    )
    return t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey")).select(
        c("c_custkey").alias("id"),
        c("n_name").alias("Country"),
        (F.floor(F.abs("c_acctbal")) % 60 + 15).cast("int").alias("Age"),
        gender.alias("Gender"),
        employees.alias("no_employees"),
    )


# --- invoices and the weekly summary -----------------------------------------

CTE["invoices"] = """
select n_name as "Country", o_orderkey as "InvoiceNo", o_custkey as "CustomerID",
       strftime(o_orderdate, '%d-%m-%Y') || ' 8.26' as "InvoiceDate", cast(o_orderdate as date) as invoice_day,
       cast(l_quantity as integer) as "Quantity", cast(l_extendedprice as decimal(12,2)) as "UnitPrice"
from lineitem join orders on l_orderkey = o_orderkey
join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""


def invoices(t: Tables) -> DataFrame:
    return (
        t.spread("lineitem", "l_orderkey", "l_quantity", "l_extendedprice")
        .join(t.orders, c("l_orderkey") == c("o_orderkey"))
        .join(t.customer, c("o_custkey") == c("c_custkey"))
        .join(t.nation, c("c_nationkey") == c("n_nationkey"))
        .select(
            c("n_name").alias("Country"),
            c("o_orderkey").alias("InvoiceNo"),
            c("o_custkey").alias("CustomerID"),
            F.concat(F.date_format("o_orderdate", "dd-MM-yyyy"), F.lit(" 8.26")).alias("InvoiceDate"),
            c("l_quantity").cast("int").alias("Quantity"),
            c("l_extendedprice").cast("decimal(12,2)").alias("UnitPrice"),
        )
    )


CTE["summary"] = """
select "Country", cast(isoyear(invoice_day) * 100 + weekofyear(invoice_day) as integer) as "WeekNumber",
       count(distinct "InvoiceNo") as "NumInvoices", cast(sum("Quantity") as bigint) as "TotalQuantity",
       cast(sum("Quantity" * "UnitPrice") as decimal(18,2)) as "InvoiceValue"
from invoices group by all
"""


def summary(t: Tables) -> DataFrame:
    """One row per country and ISO week: at most as many rows per country as the calendar has weeks."""
    day = F.to_date(F.try_to_timestamp("InvoiceDate", F.lit("dd-MM-yyyy H.mm")))
    week = F.extract(F.lit("YEAROFWEEK"), c("day")) * 100 + F.weekofyear("day")
    return (
        invoices(t)
        .withColumn("day", day)
        .groupBy("Country", week.cast("int").alias("WeekNumber"))
        .agg(
            F.count_distinct("InvoiceNo").alias("NumInvoices"),
            F.sum("Quantity").alias("TotalQuantity"),
            F.sum(c("Quantity") * c("UnitPrice")).cast("decimal(18,2)").alias("InvoiceValue"),
        )
    )


# --- flights -------------------------------------------------------------------

CTE["flights1"] = """
select o_orderkey as id, strftime(o_orderdate, '%-m/%-d/%Y') as "FL_DATE", left(o_orderpriority, 1) as "OP_CARRIER"
from orders
"""
CTE["flights2"] = """
select o_orderkey as id, o_orderpriority as "DEST", 'City ' || o_orderpriority as "DEST_CITY_NAME",
       'O' || (o_custkey % 25) as "ORIGIN", 'City ' || (o_custkey % 25) as "ORIGIN_CITY_NAME",
       cast(case when o_orderstatus = 'F' then 1 else 0 end as integer) as "CANCELLED"
from orders
"""


def flights1(t: Tables) -> DataFrame:
    return t.orders.select(
        c("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("FL_DATE"),
        F.substring("o_orderpriority", 1, 1).alias("OP_CARRIER"),
    )


def flights2(t: Tables) -> DataFrame:
    origin = (c("o_custkey") % 25).cast("string")
    return t.orders.select(
        c("o_orderkey").alias("id"),
        c("o_orderpriority").alias("DEST"),
        F.concat(F.lit("City "), c("o_orderpriority")).alias("DEST_CITY_NAME"),
        F.concat(F.lit("O"), origin).alias("ORIGIN"),
        F.concat(F.lit("City "), origin).alias("ORIGIN_CITY_NAME"),
        F.when(c("o_orderstatus") == "F", 1).otherwise(0).alias("CANCELLED"),
    )


# --- movies --------------------------------------------------------------------

CTE["movie"] = """
select o_orderkey as id,
       case when o_orderkey % 4 = 0 then 'The ' else 'A ' end || o_orderpriority || ' ' || o_orderkey as title,
       cast(year(o_orderdate) as integer) as year, cast(o_orderdate as date) as date_published,
       cast(60 + cast(floor(o_totalprice) as bigint) % 120 as integer) as duration, n_name as country,
       case o_orderkey % 3 when 1 then '$ ' || cast(floor(o_totalprice) as bigint)
            when 2 then 'INR ' || cast(floor(o_totalprice) as bigint) end as worldwide_gross_income,
       case o_orderstatus when 'O' then 'English, Hindi' when 'F' then 'Hindi' else 'English' end as languages,
       case when o_orderpriority <> '4-NOT SPECIFIED' then c_name end as production_company
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""


def movie(t: Tables) -> DataFrame:
    whole = F.floor("o_totalprice").cast("bigint")
    income = pick(
        c("o_orderkey"),
        None,
        F.concat(F.lit("$ "), whole.cast("string")),
        F.concat(F.lit("INR "), whole.cast("string")),
    )
    article = F.when(c("o_orderkey") % 4 == 0, "The ").otherwise("A ")
    return (
        t.orders.join(t.customer, c("o_custkey") == c("c_custkey"))
        .join(t.nation, c("c_nationkey") == c("n_nationkey"))
        .select(
            c("o_orderkey").alias("id"),
            F.concat(article, c("o_orderpriority"), F.lit(" "), c("o_orderkey")).alias("title"),
            F.year("o_orderdate").alias("year"),
            F.to_date("o_orderdate").alias("date_published"),
            (whole % 120 + 60).cast("int").alias("duration"),
            c("n_name").alias("country"),
            income.alias("worldwide_gross_income"),
            F.when(c("o_orderstatus") == "O", "English, Hindi")
            .when(c("o_orderstatus") == "F", "Hindi")
            .otherwise("English")
            .alias("languages"),
            F.when(c("o_orderpriority") != "4-NOT SPECIFIED", c("c_name")).alias("production_company"),
        )
    )


CTE["genre"] = """
select distinct l_orderkey as movie_id, p_type as genre from lineitem join part on l_partkey = p_partkey
"""


def genre(t: Tables) -> DataFrame:
    return (
        t.spread("lineitem", "l_orderkey", "l_partkey")
        .join(t.part, c("l_partkey") == c("p_partkey"))
        .select(c("l_orderkey").alias("movie_id"), c("p_type").alias("genre"))
        .distinct()
    )


CTE["ratings"] = """
select l_orderkey as movie_id,
       ((sum(cast(round(l_discount * 100) as bigint)) * 20 + count(*)) // (2 * count(*))) / 10.0::double as avg_rating,
       cast(sum(cast(l_quantity as bigint)) as bigint) as total_votes,
       cast(sum(cast(round(l_discount * 100) as bigint)) // count(*) as integer) as median_rating
from lineitem group by l_orderkey
"""


def ratings(t: Tables) -> DataFrame:
    """Scores in whole tenths, so their averages do not depend on summation order."""
    points = F.round(c("l_discount") * 100).cast("bigint")
    return (
        t.lineitem.groupBy(c("l_orderkey").alias("movie_id"))
        .agg(
            F.sum(points).alias("points"),
            F.count("*").alias("n"),
            F.sum(c("l_quantity").cast("bigint")).alias("total_votes"),
        )
        .select(
            "movie_id",
            (F.expr("(points * 20 + n) div (2 * n)") / 10).alias("avg_rating"),
            "total_votes",
            F.expr("points div n").cast("int").alias("median_rating"),
        )
    )


CTE["names"] = """
select c_custkey as id, c_name as name,
       case when c_acctbal >= 0 then cast(cast(floor(c_acctbal) as bigint) % 60 + 140 as integer) end as height,
       case when c_mktsegment <> 'MACHINERY' then date '1950-01-01' + cast(c_custkey % 15000 as integer) end as date_of_birth,
       case when c_nationkey >= 5 then c_mktsegment end as known_for_movies
from customer
"""


def names(t: Tables) -> DataFrame:
    born = F.date_add(F.lit("1950-01-01").cast("date"), (c("c_custkey") % 15000).cast("int"))
    return t.customer.select(
        c("c_custkey").alias("id"),
        c("c_name").alias("name"),
        F.when(c("c_acctbal") >= 0, (F.floor("c_acctbal") % 60 + 140).cast("int")).alias("height"),
        F.when(c("c_mktsegment") != "MACHINERY", born).alias("date_of_birth"),
        F.when(c("c_nationkey") >= 5, c("c_mktsegment")).alias("known_for_movies"),
    )


CTE["role_mapping"] = """
select o_orderkey as movie_id, o_custkey as name_id,
       case when o_orderpriority < '4' then 'actor' else 'actress' end as category from orders
"""
CTE["director_mapping"] = "select o_orderkey as movie_id, o_custkey as name_id from orders"


def role_mapping(t: Tables) -> DataFrame:
    return t.orders.select(
        c("o_orderkey").alias("movie_id"),
        c("o_custkey").alias("name_id"),
        F.when(c("o_orderpriority") < "4", "actor").otherwise("actress").alias("category"),
    )


def director_mapping(t: Tables) -> DataFrame:
    return t.orders.select(c("o_orderkey").alias("movie_id"), c("o_custkey").alias("name_id"))


CTE["films"] = """
select o_orderkey as id, c_name as director, 'Film ' || o_orderkey as original_title,
       concat_ws('|', c_name, n_name, case when o_orderkey % 5 = 0 then '"Guest ' || (o_orderkey % 13) || '"' end) as "cast",
       case when o_orderkey % 11 <> 0 then concat_ws('|', c_mktsegment, o_orderpriority,
            case when o_orderstatus = 'P' then 'Short Film' end) end as genres,
       case when o_orderpriority <> '5-LOW' then cast(abs(c_acctbal) * 10 as decimal(18,2)) else 0 end as budget_adj,
       cast(o_totalprice as decimal(18,2)) as revenue_adj,
       month(o_orderdate) || '/' || day(o_orderdate) || '/' || lpad(cast(o_orderkey % 100 as varchar), 2, '0') as release_date,
       cast(year(o_orderdate) as integer) as release_year, cast(o_orderkey % 100 as double) / 10 as vote_average,
       cast(o_custkey % 1000 as double) / 8 as popularity
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""


def films(t: Tables) -> DataFrame:
    guest = F.concat(F.lit('"Guest '), (c("o_orderkey") % 13).cast("string"), F.lit('"'))
    genres = F.concat_ws(
        "|", "c_mktsegment", "o_orderpriority", F.when(c("o_orderstatus") == "P", "Short Film")
    )
    year2 = F.lpad((c("o_orderkey") % 100).cast("string"), 2, "0")
    budget = F.when(c("o_orderpriority") != "5-LOW", F.abs("c_acctbal") * 10).otherwise(0.0)
    return (
        t.orders.join(t.customer, c("o_custkey") == c("c_custkey"))
        .join(t.nation, c("c_nationkey") == c("n_nationkey"))
        .select(
            c("o_orderkey").alias("id"),
            c("c_name").alias("director"),
            F.concat(F.lit("Film "), c("o_orderkey")).alias("original_title"),
            F.concat_ws("|", "c_name", "n_name", F.when(c("o_orderkey") % 5 == 0, guest)).alias("cast"),
            F.when(c("o_orderkey") % 11 != 0, genres).alias("genres"),
            budget.cast("decimal(18,2)").alias("budget_adj"),
            c("o_totalprice").cast("decimal(18,2)").alias("revenue_adj"),
            F.concat_ws("/", F.month("o_orderdate"), F.day("o_orderdate"), year2).alias("release_date"),
            F.year("o_orderdate").alias("release_year"),
            ((c("o_orderkey") % 100).cast("double") / 10).alias("vote_average"),
            ((c("o_custkey") % 1000).cast("double") / 8).alias("popularity"),
        )
    )
