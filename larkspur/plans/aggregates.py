"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions import text as tx
from larkspur.operators import aggregates as a
from larkspur.operators.ordered import exact_percentiles
from larkspur.plans import standins as s
from larkspur.plans.registry import Tables, query
from larkspur.session import cut_lineage

c = F.col


@query(
    "a01_rows_per_table",
    s.with_("movie", "genre", "ratings", "names", "role_mapping", "director_mapping")
    + " union ".join(
        f"select '{n}' as tables, count(*) as row_num from {n}"
        for n in ("director_mapping", "genre", "movie", "names", "ratings", "role_mapping")
    ),
)
def a01(t: Tables):
    frames = {
        "director_mapping": s.director_mapping(t),
        "genre": s.genre(t),
        "movie": s.movie(t),
        "names": s.names(t),
        "ratings": s.ratings(t),
        "role_mapping": s.role_mapping(t),
    }
    return a.table_sizes(frames)


@query(
    "a02_group_count",
    s.with_("survey") + """select "Country", count(1) as count from survey where "Age" < 40 group by "Country" """,
)
def a02(t: Tables):
    return s.survey(t).where(c("Age") < 40).groupBy("Country").count().orderBy(F.desc("count"), "Country")


@query(
    "a02_movies_per_median_rating",
    s.with_("movie", "ratings")
    + "select median_rating, count(*) as movie_count from ratings join movie on id = movie_id group by 1",
)
def a02_ratings(t: Tables):
    films = s.movie(t).select("id")
    return (
        s.ratings(t).join(films, c("movie_id") == c("id")).groupBy("median_rating").agg(F.count("*").alias("movie_count"))
    )


@query(
    "a03_group_by_month",
    s.with_("movie")
    + "select cast(extract(month from date_published) as integer) as month_num, count(1) as number_of_movies from movie group by 1",
)
def a03_month(t: Tables):
    return s.movie(t).groupBy(F.month("date_published").alias("month_num")).agg(F.count("*").alias("number_of_movies"))


@query("a03_group_by_year", s.with_("movie") + "select year, count(1) as number_of_movies from movie group by year")
def a03_year(t: Tables):
    return s.movie(t).groupBy("year").agg(F.count("*").alias("number_of_movies"))


@query(
    "a04_multi_aggregate",
    s.with_("invoices")
    + """select "Country", cast(year(invoice_day) as integer) as "Year", count(distinct "InvoiceNo") as num_invoices,
         cast(sum("Quantity") as bigint) as total_quantity, cast(sum("Quantity" * "UnitPrice") as double) as invoice_value
         from invoices group by 1, 2""",
)
def a04(t: Tables):
    day = F.try_to_timestamp("InvoiceDate", F.lit("dd-MM-yyyy H.mm"))
    return (
        s.invoices(t)
        .withColumn("Year", F.year(day))
        .groupBy("Country", "Year")
        .agg(
            F.count_distinct("InvoiceNo").alias("num_invoices"),
            F.sum("Quantity").alias("total_quantity"),
            F.round(F.sum(c("Quantity") * c("UnitPrice")), 2).cast("double").alias("invoice_value"),
        )
        .orderBy("Country", "Year")
    )


@query(
    "a05_average_rounded",
    s.with_("movie", "genre")
    + """select genre, round(cast(sum(duration) as double) / count(*), 2) as avg_duration
         from genre join movie on id = movie_id group by genre""",
)
def a05(t: Tables):
    films = s.movie(t).select("id", "duration")
    return (
        s.genre(t)
        .join(films, c("id") == c("movie_id"))
        .groupBy("genre")
        .agg(F.round(F.avg("duration"), 2).alias("avg_duration"))
    )


@query(
    "a06_min_max_columns",
    s.with_("ratings")
    + """select min(avg_rating) as min_avg_rating, max(avg_rating) as max_avg_rating, min(total_votes) as min_total_votes,
         max(total_votes) as max_total_votes, min(median_rating) as min_median_rating, max(median_rating) as max_median_rating from ratings""",
)
def a06(t: Tables):
    return s.ratings(t).agg(
        *[f(x).alias(f"{n}_{x}") for x in ("avg_rating", "total_votes", "median_rating") for n, f in (("min", F.min), ("max", F.max))]
    )


@query("a07_grand_total", s.with_("films") + "select cast(sum(revenue_adj) as double) as total_revenue from films")
def a07(t: Tables):
    return s.films(t).agg(F.sum("revenue_adj").cast("double").alias("total_revenue"))


@query(
    "a08_conditional_counts",
    s.with_("survey")
    + """select "Country", cast(count(*) filter (lower("Gender") in ('male', 'man', 'm')) as bigint) as num_male,
         cast(count(*) filter (lower("Gender") in ('female', 'woman', 'f')) as bigint) as num_female
         from survey where "Gender" is not null group by "Country" """,
)
def a08(t: Tables):
    word = F.lower("Gender")
    return (
        s.survey(t)
        .where(c("Gender").isNotNull())
        .groupBy("Country")
        .agg(
            F.count_if(word.isin("male", "man", "m")).alias("num_male"),
            F.count_if(word.isin("female", "woman", "f")).alias("num_female"),
        )
        .orderBy("Country")
    )


@query(
    "a08_conditional_sums",
    s.with_("survey")
    + """select "Country", cast(sum(case when lower("Gender") in ('male', 'm') then 1 else 0 end) as bigint) as num_male,
         cast(sum(case when lower("Gender") in ('female', 'f') then 1 else 0 end) as bigint) as num_female from survey group by "Country" """,
)
def a08_sums(t: Tables):
    word = F.lower("Gender")
    return (
        s.survey(t)
        .groupBy("Country")
        .agg(
            F.sum(F.when((word == "male") | (word == "m"), 1).otherwise(0)).alias("num_male"),
            F.sum(F.when((word == "female") | (word == "f"), 1).otherwise(0)).alias("num_female"),
        )
    )


@query(
    "a08_intent_males_under_40",
    s.with_("survey")
    + """select "Country", count(*) as count from survey where "Age" < 40 and lower("Gender") in ('male', 'man', 'm') group by 1""",
)
def a08_intent(t: Tables):
    males = F.lower("Gender").isin("male", "man", "m")
    return s.survey(t).where((c("Age") < 40) & males).groupBy("Country").count()


@query(
    "a08_intent_female_w",
    s.with_("survey")
    + """select "Country", cast(count(*) filter (lower("Gender") in ('female', 'woman', 'w')) as bigint) as num_female
         from survey where "Gender" is not null group by "Country" """,
)
def a08_intent_female(t: Tables):
    return (
        s.survey(t)
        .where(c("Gender").isNotNull())
        .groupBy("Country")
        .agg(F.count_if(F.lower("Gender").isin("female", "woman", "w")).alias("num_female"))
    )


@query(
    "a08_cancelled_by_carrier",
    s.with_("flights1", "flights2")
    + """select "OP_CARRIER", "ORIGIN", cast(count(*) filter ("CANCELLED" = 1) as bigint) as "CANCELLED_COUNT"
         from flights1 join flights2 using (id) group by 1, 2""",
)
def a08_carrier(t: Tables):
    return (
        s.flights1(t)
        .join(s.flights2(t), "id")
        .groupBy("OP_CARRIER", "ORIGIN")
        .agg(F.count(F.when(c("CANCELLED") == 1, 1)).alias("CANCELLED_COUNT"))
        .orderBy("OP_CARRIER", "ORIGIN")
    )


@query(
    "a09_having_single_genre",
    s.with_("genre") + "select count(*) as movies from (select movie_id from genre group by movie_id having count(*) = 1)",
)
def a09(t: Tables):
    return (
        s.genre(t)
        .groupBy("movie_id")
        .agg(F.count("*").alias("n"))
        .where("n = 1")
        .agg(F.count("*").alias("movies"))
    )


@query(
    "a10_weighted_average",
    s.with_("movie", "ratings")
    + """select country, round(cast(sum(cast(round(avg_rating * 10) as bigint) * total_votes) as double) / 10 / sum(total_votes), 6) as weighted_rating
         from movie join ratings on id = movie_id group by country""",
)
def a10(t: Tables):
    tenths = F.round(c("avg_rating") * 10).cast("bigint")
    films = s.movie(t).select("id", "country")
    return (
        films.join(s.ratings(t), c("id") == c("movie_id"))
        .groupBy("country")
        .agg(F.round(a.weighted_average(tenths, c("total_votes")) / 10, 6).alias("weighted_rating"))
    )


@query("a11_distinct_values", s.with_("genre") + "select distinct genre from genre")
def a11(t: Tables):
    return s.genre(t).select("genre").distinct()


@query("a11_distinct_tuples", "select distinct l_partkey, l_suppkey from lineitem where l_returnflag in ('A', 'R')")
def a11_tuples(t: Tables):
    return t.lineitem.where(c("l_returnflag").isin("A", "R")).select("l_partkey", "l_suppkey").distinct()


_MOVIE_COLUMNS = ("date_published", "duration", "year", "worldwide_gross_income", "languages", "id", "production_company", "title", "country")


@query(
    "a12_null_audit_rows",
    s.with_("movie")
    + "select column_name, case when count_null > 0 then 'NULL_OCCUR' else 'NO_NULL' end as check_null from ("
    + " union ".join(f"select '{x}' as column_name, count(1) as count_null from movie where {x} is null" for x in _MOVIE_COLUMNS)
    + ")",
)
def a12(t: Tables):
    return a.null_audit(s.movie(t), _MOVIE_COLUMNS)


@query(
    "a13_null_audit_wide",
    s.with_("names")
    + """select cast(sum(case when name is null then 1 else 0 end) as bigint) as name_nulls,
         cast(sum(case when height is null then 1 else 0 end) as bigint) as height_nulls,
         cast(sum(case when date_of_birth is null then 1 else 0 end) as bigint) as date_of_birth_nulls,
         cast(sum(case when known_for_movies is null then 1 else 0 end) as bigint) as known_for_movies_nulls from names""",
)
def a13(t: Tables):
    columns = ("name", "height", "date_of_birth", "known_for_movies")
    return a.null_counts_wide(s.names(t), {x: f"{x}_nulls" for x in columns})


s.CTE["roi"] = """
select id, release_year, genres, "cast", director, popularity, cast(budget_adj as double) as budget, cast(revenue_adj as double) as revenue,
       case when budget_adj = 0 then case when revenue_adj > budget_adj then 'inf'::double when revenue_adj < budget_adj then '-inf'::double end
            else cast(revenue_adj - budget_adj as double) / cast(budget_adj as double) * 100 end as roi
from films"""


def with_roi(t: Tables):
    profit = (c("revenue_adj") - c("budget_adj")).cast("double")
    return s.films(t).withColumn("roi", a.ratio_percent(profit, c("budget_adj").cast("double")))


def roi_rows(t: Tables, *columns: str):
    """The returns and these columns, written once: percentiles read their input more than once."""
    return cut_lineage(t.spark, with_roi(t).select(*columns, "roi"), "roi")


@query(
    "a14_median_global",
    s.with_("films", "roi") + "select round(median(roi), 4) as median_roi from roi where not isinf(roi)",
)
def a14(t: Tables):
    """Infinite returns are taken out before the median."""
    finite = roi_rows(t).select(a.finite_or_null(c("roi")).alias("roi"))
    return exact_percentiles(finite, "roi", {"median_roi": 0.5}).select(F.round("median_roi", 4).alias("median_roi"))


@query(
    "a14_median_per_year",
    s.with_("films", "roi")
    + "select release_year, round(median(roi), 4) as median_roi from roi where budget <> 0 group by release_year",
)
def a14_year(t: Tables):
    paid = roi_rows(t, "release_year", "budget_adj").where(c("budget_adj") != 0)
    return exact_percentiles(paid, "roi", {"m": 0.5}, ["release_year"]).select(
        "release_year", F.round("m", 4).alias("median_roi")
    )


@query(
    "a14_median_per_genre_with_infinite",
    s.with_("films", "roi")
    + """select genre, round(m, 4) as median_roi from (select genre, median(roi) as m from
         (select unnest(string_split(coalesce(genres, ''), '|')) as genre, roi from roi) group by genre) where isfinite(m)""",
)
def a14_genre(t: Tables):
    """Infinite returns take part in the median; groups whose median is infinite are dropped."""
    exploded = roi_rows(t, "genres").select(
        F.explode(F.split(F.coalesce("genres", F.lit("")), r"\|")).alias("genre"), "roi"
    )
    medians = exact_percentiles(exploded, "roi", {"m": 0.5}, ["genre"])
    return medians.where(a.finite_or_null(c("m")).isNotNull()).select("genre", F.round("m", 4).alias("median_roi"))


@query(
    "a14_top_cast_by_median",
    s.with_("films", "roi")
    + """select name, round(m, 4) as median_roi from (select name, median(roi) as m from
         (select unnest(string_split(coalesce("cast", ''), '|')) as name, roi from roi) group by name)
         where isfinite(m) order by m desc, name limit 20""",
)
def a14_cast(t: Tables):
    exploded = roi_rows(t, "cast").select(F.explode(F.split(F.coalesce("cast", F.lit("")), r"\|")).alias("name"), "roi")
    medians = exact_percentiles(exploded, "roi", {"m": 0.5}, ["name"])
    top = medians.where(a.finite_or_null(c("m")).isNotNull()).orderBy(F.desc("m"), "name").limit(20)
    return top.select("name", F.round("m", 4).alias("median_roi"))


@query(
    "a15_pearson",
    s.with_("films", "roi")
    + """select round(corr(budget, revenue), 6) as budget_revenue,
         round(corr(case when not isinf(roi) then popularity end, case when not isinf(roi) then roi end), 6) as popularity_roi from roi""",
)
def a15(t: Tables):
    movies = with_roi(t)
    roi = a.finite_or_null(c("roi"))
    return movies.agg(
        F.round(F.corr(c("budget_adj").cast("double"), c("revenue_adj").cast("double")), 6).alias("budget_revenue"),
        F.round(F.corr(F.when(roi.isNotNull(), c("popularity")), roi), 6).alias("popularity_roi"),
    )


@query(
    "a16_linear_fit",
    s.with_("films", "roi")
    + """select round(regr_slope(revenue, budget), 6) as slope, round(regr_intercept(revenue, budget), 2) as intercept,
         round(regr_r2(revenue, budget), 6) as r2 from roi""",
)
def a16(t: Tables):
    y, x = c("revenue_adj").cast("double"), c("budget_adj").cast("double")
    return s.films(t).agg(
        F.round(F.regr_slope(y, x), 6).alias("slope"),
        F.round(F.regr_intercept(y, x), 2).alias("intercept"),
        F.round(F.regr_r2(y, x), 6).alias("r2"),
    )


_GENRE_TOKENS = """select unnest(string_split(replace(replace(genres, '"', ''), ' ', '_'), '|')) as name from {src} where genres is not null"""


@query(
    "a17_list_frequency_shell",
    s.with_("films") + f"select name, count(*) as frequency from ({_GENRE_TOKENS.format(src='films')}) where name <> '' group by name",
)
def a17(t: Tables):
    """Shell flavour: rows are not made distinct, blanks become '_'."""
    tokens = s.films(t).select(F.explode(tx.split_tokens(c("genres"))).alias("name"))
    return a.value_counts(tokens, "name", "frequency")


@query(
    "a17_list_frequency_notebook",
    s.with_("films")
    + """select genre, count(*) as count from (select unnest(string_split(genres, '|')) as genre from
         (select distinct * from (select * from films union all select * from films where id % 2 = 0))) where genre <> '' group by genre""",
)
def a17_notebook(t: Tables):
    """Notebook flavour: duplicate rows are dropped first, names are kept as written."""
    movies = s.films(t)
    repeated = movies.unionByName(movies.where(c("id") % 2 == 0))
    names = repeated.distinct().select(F.explode(F.split("genres", r"\|")).alias("genre")).where("genre <> ''")
    return a.value_counts(names, "genre")


@query(
    "a18_most_frequent_value",
    s.with_("films") + "select director, count(*) as count from films group by 1 order by 2 desc, 1 limit 1",
)
def a18(t: Tables):
    return a.most_frequent(s.films(t), "director")


@query(
    "a18_most_frequent_cast",
    s.with_("films")
    + """select name, count(*) as frequency from (select unnest(string_split(replace(replace("cast", '"', ''), ' ', '_'), '|')) as name from films)
         where name <> '' group by 1 order by 2 desc, 1 limit 1""",
)
def a18_cast(t: Tables):
    tokens = s.films(t).select(F.explode(tx.split_tokens(c("cast"))).alias("name"))
    return a.most_frequent(tokens, "name", 1, "frequency")


@query(
    "a19_top_value_counts",
    "select word, count(*) as count from (select unnest(string_split(text, ' ')) as word from documents) group by word order by 2 desc, 1 limit 10",
)
def a19(t: Tables):
    return a.most_frequent(t.spread("documents", "text").select(F.explode(F.split("text", " ")).alias("word")), "word", 10)


@query(
    "a20_argmax_per_parent",
    s.with_("films")
    + """select release_year, genre, count from (select release_year, genre, count(*) as count,
           row_number() over (partition by release_year order by count(*) desc, genre) as r
         from (select release_year, unnest(string_split(coalesce(genres, ''), '|')) as genre from films) group by 1, 2) where r = 1""",
)
def a20(t: Tables):
    exploded = s.films(t).select(
        "release_year", F.explode(F.split(F.coalesce("genres", F.lit("")), r"\|")).alias("genre")
    )
    return a.most_frequent_per(exploded, "release_year", "genre")


@query(
    "a21_rows_at_extremes",
    s.with_("films")
    + """select id, original_title, vote_average from films where vote_average = (select min(vote_average) from films)
         or vote_average = (select max(vote_average) from films)""",
)
def a21(t: Tables):
    return a.rows_at_extremes(s.films(t), "vote_average").select("id", "original_title", "vote_average")


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(
    "a22_crosstab",
    "select n_name as city, "
    + ", ".join(f"cast(count(*) filter (c_mktsegment = '{x}') as bigint) as \"{x}\"" for x in _SEGMENTS)
    + " from customer join nation on c_nationkey = n_nationkey group by 1",
)
def a22(t: Tables):
    cities = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey")).withColumnRenamed("n_name", "city")
    return a.crosstab(cities, "city", "c_mktsegment", _SEGMENTS)


@query(
    "a23_unpivot",
    """select p_partkey, 'retail' as price_type, p_retailprice as price from part
       union all select p_partkey, 'size', cast(p_size as double) from part""",
)
def a23(t: Tables):
    wide = t.part.select("p_partkey", c("p_retailprice").alias("retail"), c("p_size").cast("double").alias("size"))
    return wide.unpivot("p_partkey", ["retail", "size"], "price_type", "price")


@query(
    "a24_box_plot",
    """with q as (select l_returnflag, quantile_cont(l_extendedprice, 0.25) as q1, median(l_extendedprice) as m,
                  quantile_cont(l_extendedprice, 0.75) as q3 from lineitem group by 1)
       select l_returnflag, round(q1, 4) as q1, round(m, 4) as median, round(q3, 4) as q3, min(l_extendedprice) as whisker_low,
              max(l_extendedprice) as whisker_high
       from lineitem join q using (l_returnflag)
       where l_extendedprice between q1 - (q3 - q1) * 1.5 and q3 + (q3 - q1) * 1.5 group by 1, 2, 3, 4""",
)
def a24(t: Tables):
    box = a.box_plot(t.lineitem.select("l_returnflag", "l_extendedprice"), ["l_returnflag"], "l_extendedprice")
    return box.withColumns({x: F.round(x, 4) for x in ("q1", "median", "q3")})


@query(
    "a25_values_per_key",
    """with pairs as (select distinct l_suppkey as key, l_partkey as v from lineitem),
            p as (select key, cast(ceil(count(*) / 50) as bigint) as parts from pairs group by key)
       select key, cast(('0x' || substr(md5(cast(v as varchar)), 1, 7))::bigint % parts as bigint) as part, parts, count(*) as n_values,
              string_agg(v, ',' order by v) as value_list
       from pairs join p using (key) group by all""",
)
def a25(t: Tables):
    lists = a.lists_per_key(t.lineitem.select(c("l_suppkey").alias("key"), c("l_partkey").alias("v")), "key", "v", chunk=50)
    return lists.select(
        "key", "part", "parts", F.size("values").cast("bigint").alias("n_values"),
        F.array_join(c("values").cast("array<string>"), ",").alias("value_list"),
    )


@query(
    "a26_duplicate_keys",
    "select l_orderkey, l_linenumber, count(*) as count from lineitem group by 1, 2 having count(*) > 1",
)
def a26(t: Tables):
    return a.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "a26_duplicated_rows",
    """select l_orderkey, l_linenumber, l_partkey, l_extendedprice from lineitem
       qualify count(*) over (partition by l_orderkey, l_linenumber) > 1""",
)
def a26_rows(t: Tables):
    return a.duplicated_rows(t.lineitem, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )


@query(
    "a29_numeric_field_stats",
    """select min(ts) as min_value, max(ts) as max_value, cast(sum(ts) as double) / count(ts) as avg_value
       from (select cast(floor(epoch(ts)) as bigint) as ts from events)""",
)
def a29(t: Tables):
    seconds = t.events.select(F.unix_timestamp(c("ts").cast("timestamp")).alias("time_stamp"))
    return a.field_stats(seconds, "time_stamp")


@query(
    "a32_above_group_mean",
    """select o_orderkey, o_totalprice > avg_price as above_mean from orders join
       (select o_orderpriority as p, sum(cast(o_totalprice as decimal(28,4))) / count(*) as avg_price from orders group by 1) on p = o_orderpriority""",
)
def a32(t: Tables):
    prices = t.orders.withColumn("price", c("o_totalprice").cast("decimal(28,4)"))
    return a.above_group_mean(prices, "o_orderpriority", "price").select("o_orderkey", "above_mean")


@query(
    "a32_fine_values",
    """with v as (select o_orderkey, o_custkey % 5 as g, (o_orderkey % 8) / 1048576.0::double as tiny, (o_orderkey % 8) * 1e25::double as huge from orders),
            m as (select g, avg(tiny) as mt, avg(huge) as mh from v group by g)
       select o_orderkey, tiny > mt as tiny_above, huge > mh as huge_above from v join m using (g)""",
)
def a32_fine(t: Tables):
    """Values far below one and far above any decimal type."""
    step = (c("o_orderkey") % 8).cast("double")
    values = t.orders.select("o_orderkey", (c("o_custkey") % 5).alias("g"), (step / 1048576.0).alias("tiny"), (step * F.lit(1e25)).alias("huge"))
    flagged = a.above_group_mean(a.above_group_mean(values, "g", "tiny", "tiny_above"), "g", "huge", "huge_above")
    return flagged.select("o_orderkey", "tiny_above", "huge_above")


@query(
    "a33_second_extremes",
    """with d as (select distinct o_custkey, o_totalprice as v from orders)
       select o_custkey, min(v) filter (lo = 2) as second_min, min(v) filter (hi = 2) as second_max
       from (select *, row_number() over (partition by o_custkey order by v) as lo,
             row_number() over (partition by o_custkey order by v desc) as hi from d) group by 1 having count(*) > 1""",
)
def a33(t: Tables):
    return a.second_extremes(t.orders, "o_custkey", "o_totalprice")


@query(
    "a34_common_prefix",
    """with g as (select p_brand, p_type, min(lower(p_name)) as lo, max(lower(p_name)) as hi from part group by 1, 2),
            n as (select *, coalesce((select max(i) from range(1, 100) r(i) where i <= least(length(lo), length(hi))
                   and substr(lo, 1, i) = substr(hi, 1, i)), 0) as k from g)
       select p_brand, p_type, case when k = 0 then '-1' else substr(lo, 1, k) end as prefix from n""",
)
def a34(t: Tables):
    name = F.lower("p_name")
    groups = t.part.groupBy("p_brand", "p_type").agg(F.min(name).alias("lo"), F.max(name).alias("hi"))
    return groups.select("p_brand", "p_type", tx.common_prefix(c("lo"), c("hi")).alias("prefix"))


@query(
    "a35_summary_refresh",
    s.with_("survey") + """select "Gender" as gender, count(1) as num_users from survey group by 1""",
)
def a35(t: Tables):
    """The table holds other rows before; each run has a table of its own."""
    from larkspur.operators.mutation import refresh_table, replace_table, unique_name

    counts = s.survey(t).groupBy(c("Gender").alias("gender")).agg(F.count("*").alias("num_users"))
    name = unique_name("user_reports")
    replace_table(counts.withColumn("num_users", -c("num_users")), name)
    return refresh_table(counts, name)
