"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions import money
from larkspur.operators.relational import null_count, sentinels_to_null, split_rows, with_unknown_member
from larkspur.plans import standins as s
from larkspur.plans.registry import Tables, query

c = F.col


@query(
    "p01_select_rename_except",
    """select o_orderkey as order_key, o_custkey, o_orderstatus, o_totalprice as price, o_orderpriority from orders""",
)
def p01(t: Tables):
    return (
        t.orders.withColumnRenamed("o_orderkey", "order_key")
        .withColumnRenamed("o_totalprice", "price")
        .drop("o_orderdate")
    )


@query(
    "p02_derived_arithmetic",
    s.with_("films")
    + """select id, cast(revenue_adj - budget_adj as double) as profit,
        round(cast((revenue_adj - budget_adj) as double) / nullif(cast(budget_adj as double), 0) * 100, 4) as roi from films""",
)
def p02(t: Tables):
    profit = c("revenue_adj") - c("budget_adj")
    roi = F.try_divide(profit.cast("double"), c("budget_adj").cast("double")) * 100
    return s.films(t).select("id", profit.cast("double").alias("profit"), F.round(roi, 4).alias("roi"))


@query("p03_numeric_filter", s.with_("films") + "select id, vote_average from films where vote_average > 7.5")
def p03(t: Tables):
    return s.films(t).where(c("vote_average") > 7.5).select("id", "vote_average")


@query(
    "p04_and_or_filter",
    s.with_("movie")
    + """select country, count(*) as movie_count from movie
         where (country = 'NATION_3' or country = 'NATION_7') and year = 1999 group by country""",
)
def p04(t: Tables):
    wanted = ((c("country") == "NATION_3") | (c("country") == "NATION_7")) & (c("year") == 1999)
    return s.movie(t).where(wanted).groupBy("country").agg(F.count("*").alias("movie_count"))


@query(
    "p05_in_list_total_votes",
    s.with_("movie", "ratings")
    + """select country, cast(sum(total_votes) as bigint) as total_votes from movie join ratings on id = movie_id
         where country in ('NATION_4', 'NATION_9') group by country""",
)
def p05(t: Tables):
    chosen = s.movie(t).where(c("country").isin("NATION_4", "NATION_9"))
    return (
        chosen.join(s.ratings(t), c("id") == c("movie_id"))
        .groupBy("country")
        .agg(F.sum("total_votes").alias("total_votes"))
    )


@query(
    "p06_between_dates",
    s.with_("movie", "ratings")
    + """select count(*) as movie_count from movie join ratings on id = movie_id
         where date_published between date '1998-04-01' and date '1999-04-01' and median_rating = 5""",
)
def p06(t: Tables):
    period = c("date_published").between(F.lit("1998-04-01").cast("date"), F.lit("1999-04-01").cast("date"))
    return (
        s.movie(t)
        .where(period)
        .join(s.ratings(t).where(c("median_rating") == 5), c("id") == c("movie_id"))
        .agg(F.count("*").alias("movie_count"))
    )


@query(
    "p07_like_prefix",
    s.with_("movie", "genre", "ratings")
    + """select title, avg_rating, genre from movie join genre on id = genre.movie_id
         join ratings on id = ratings.movie_id where title like 'The%' and avg_rating > 8""",
)
def p07(t: Tables):
    rated = s.ratings(t).where(c("avg_rating") > 8)
    return (
        s.movie(t)
        .where(c("title").like("The%"))
        .join(rated, c("id") == rated["movie_id"])
        .drop("movie_id")
        .join(s.genre(t), c("id") == c("movie_id"))
        .select("title", "avg_rating", "genre")
    )


@query(
    "p08_substring_presence",
    """select cast(count(*) filter (contains(line, 'a')) as bigint) as lines_with_a,
              cast(count(*) filter (contains(line, 'b')) as bigint) as lines_with_b
       from (select unnest(string_split(text, chr(10))) as line from documents)""",
)
def p08(t: Tables):
    line = F.explode(F.split("text", "\n")).alias("line")
    return t.documents.select(line).agg(
        F.count_if(c("line").contains("a")).alias("lines_with_a"),
        F.count_if(c("line").contains("b")).alias("lines_with_b"),
    )


@query(
    "p08_multilingual_houses_top2",
    s.with_("movie", "ratings")
    + """select production_company, movie_count, prod_comp_rank from (
           select production_company, count(*) as movie_count,
                  cast(dense_rank() over (order by count(*) desc) as integer) as prod_comp_rank
           from movie join ratings on movie_id = id
           where position(',' in languages) > 0 and median_rating >= 5 and production_company is not null
           group by production_company) where prod_comp_rank <= 2""",
)
def p08_houses(t: Tables):
    from larkspur.operators.ordered import dense_top_k

    hits = (
        s.movie(t)
        .where((F.instr("languages", ",") > 0) & c("production_company").isNotNull())
        .join(s.ratings(t).where(c("median_rating") >= 5), c("movie_id") == c("id"))
        .groupBy("production_company")
        .agg(F.count("*").alias("movie_count"))
    )
    return dense_top_k(hits, "movie_count", 2, name="prod_comp_rank")


@query(
    "p09_null_tests",
    s.with_("names")
    + """select count(*) as rows_all, cast(count(*) filter (height is not null) as bigint) as with_height,
         cast(count(*) filter (known_for_movies <> 'MACHINERY') as bigint) as not_machinery from names""",
)
def p09(t: Tables):
    return s.names(t).agg(
        F.count("*").alias("rows_all"),
        F.count_if(c("height").isNotNull()).alias("with_height"),
        F.count_if(c("known_for_movies") != "MACHINERY").alias("not_machinery"),
    )


@query(
    "p10_row_split",
    s.with_("survey")
    + """select case when coalesce("Age" >= 18 and "Gender" is not null, false) then 'process' else 'skip' end as branch,
         count(*) as rows from survey group by 1""",
)
def p10(t: Tables):
    process, skip = split_rows(s.survey(t), (c("Age") >= 18) & c("Gender").isNotNull())
    counted = [
        part.agg(F.count("*").alias("rows")).select(F.lit(name).alias("branch"), "rows")
        for name, part in (("process", process), ("skip", skip))
    ]
    return counted[0].unionByName(counted[1])


@query(
    "p11_case_buckets",
    s.with_("movie", "genre", "ratings")
    + """select title, case when avg_rating > 8 then 'Superhit movies' when avg_rating >= 7 and avg_rating <= 8 then 'Hit movies'
              when avg_rating >= 5 and avg_rating < 7 then 'One-time-watch movies' else 'Flop movies' end as classification
         from movie join genre on genre.movie_id = id join ratings on ratings.movie_id = id where genre = 'PROMO'""",
)
def p11(t: Tables):
    score = c("avg_rating")
    bucket = (
        F.when(score > 8, "Superhit movies")
        .when((score >= 7) & (score <= 8), "Hit movies")
        .when((score >= 5) & (score < 7), "One-time-watch movies")
        .otherwise("Flop movies")
    )
    chosen = s.genre(t).where(c("genre") == "PROMO").select(c("movie_id").alias("gid"))
    return (
        s.movie(t)
        .join(chosen, c("id") == c("gid"))
        .join(s.ratings(t), c("id") == c("movie_id"))
        .select("title", bucket.alias("classification"))
    )


@query(
    "p12_default_for_null",
    s.with_("movie")
    + """select id, coalesce(production_company, 'XNA') as production_company,
         coalesce(worldwide_gross_income, '') as worldwide_gross_income from movie""",
)
def p12(t: Tables):
    return (
        s.movie(t)
        .select("id", F.coalesce("production_company", F.lit("XNA")).alias("production_company"), "worldwide_gross_income")
        .na.fill({"worldwide_gross_income": ""})
    )


@query(
    "p13_sentinel_to_null",
    """select c_custkey, case when c_mktsegment <> 'MACHINERY' and trim(c_mktsegment) <> '' then c_mktsegment end as segment,
              case when c_acctbal <> 0 and not isinf(c_acctbal) then c_acctbal end as balance from customer""",
)
def p13(t: Tables):
    base = t.customer.select("c_custkey", c("c_mktsegment").alias("segment"), "c_acctbal")
    finite = F.abs("c_acctbal") < F.lit(float("inf"))
    return sentinels_to_null(base, ["segment"], ["-", "MACHINERY"]).select(
        "c_custkey", "segment", F.when(finite & (c("c_acctbal") != 0), c("c_acctbal")).alias("balance")
    )


@query(
    "p14_drop_null_rows",
    s.with_("names")
    + """select 'any' as rule, count(*) as rows from names where height is not null and date_of_birth is not null and known_for_movies is not null
         union all select 'subset', count(*) from names where height is not null
         union all select 'all of set', count(*) from names where height is not null or known_for_movies is not null""",
)
def p14(t: Tables):
    people = s.names(t)
    kept = {
        "any": people.na.drop("any"),
        "subset": people.na.drop(subset=["height"]),
        "all of set": people.na.drop("all", subset=["height", "known_for_movies"]),
    }
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(rule).alias("rule"), "rows") for rule, df in kept.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    "p15_null_count_filter",
    s.with_("names")
    + """select id, cast((height is null)::int + (date_of_birth is null)::int + (known_for_movies is null)::int as integer) as nulls
         from names where (height is null)::int + (date_of_birth is null)::int + (known_for_movies is null)::int >= 2""",
)
def p15(t: Tables):
    nulls = null_count(["height", "date_of_birth", "known_for_movies"])
    return s.names(t).where(nulls >= 2).select("id", nulls.alias("nulls"))


@query(
    "p16_unknown_member",
    """select p_partkey as product_key, p_name as product_name from part union all select -1, 'XNA'""",
)
def p16(t: Tables):
    products = t.part.select(c("p_partkey").alias("product_key"), c("p_name").alias("product_name"))
    return with_unknown_member(products, "product_key", -1)


_SALARY_SQL = """
select p_partkey as id, p_partkey % 9 = 0 as negotiable,
       case when p_size % 4 = 0 then 0.0 when p_size % 4 = 1 then 1000.0 * p_size when p_size % 4 = 2 then 7000000.0 * p_size end as lo0,
       case when p_size % 5 = 0 then 0.0 when p_size % 5 = 1 then 2000.0 * p_size when p_size % 5 = 2 then 9000000.0 * p_size end as hi0,
       case when p_partkey % 3 = 0 then 'M VND' else 'USD' end as u0
from part"""


@query(
    "p17_unit_repair",
    "with a as ("
    + _SALARY_SQL
    + """), b as (select id, negotiable, nullif(lo0, 0) as lo, nullif(hi0, 0) as hi, u0 from a),
    d as (select *, case when not negotiable and u0 = 'USD' and lo > 1e5 then 'M VND' else u0 end as u1 from b),
    e as (select *, case when not negotiable and u1 = 'USD' and hi > 1e5 then 'M VND' else u1 end as u2 from d)
    select id, round(case when u1 <> u0 then lo * 1e-6 when not negotiable and u2 = 'USD' then lo * 25554 * 1e-6 else lo end, 6) as salary_min,
           round(case when u2 <> u1 then hi * 1e-6 when not negotiable and u2 = 'USD' then hi * 25554 * 1e-6 else hi end, 6) as salary_max,
           'M VND' as salary_unit from e""",
)
def p17(t: Tables):
    size = c("p_size")
    low = F.when(size % 4 == 0, 0.0).when(size % 4 == 1, size * 1000.0).when(size % 4 == 2, size * 7000000.0)
    high = F.when(size % 5 == 0, 0.0).when(size % 5 == 1, size * 2000.0).when(size % 5 == 2, size * 9000000.0)
    salaries = t.part.select(
        c("p_partkey").alias("id"),
        (c("p_partkey") % 9 == 0).alias("negotiable"),
        low.alias("salary_min"),
        high.alias("salary_max"),
        F.when(c("p_partkey") % 3 == 0, "M VND").otherwise("USD").alias("salary_unit"),
    )
    return money.repair_salaries(salaries).select(
        "id",
        F.round("salary_min", 6).alias("salary_min"),
        F.round("salary_max", 6).alias("salary_max"),
        "salary_unit",
    )
