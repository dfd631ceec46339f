"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.functions.money import exchange_rates
from larkspur.operators import joins as j
from larkspur.operators.ordered import dense_top_k
from larkspur.plans import standins as s
from larkspur.plans.registry import Tables, query
from larkspur.sources.literal import literal_rows

c = F.col


def fx_cte() -> str:
    """The rate table as SQL values."""
    from larkspur.functions.money import EXCHANGE_RATES

    rows = ", ".join(f"('{symbol}', '{code}', {rate!r}::double)" for symbol, code, _, rate, _ in EXCHANGE_RATES)
    return f"select * from (values {rows}) as v(symbol, code, exchange_rate)"


s.CTE["fx"] = fx_cte()


@query(
    "j01_inner_using",
    s.with_("flights1", "flights2")
    + """select id, "DEST", "DEST_CITY_NAME", strftime(strptime("FL_DATE", '%m/%d/%Y'), '%Y-%m-%d') as "FL_DATE",
         "ORIGIN", "ORIGIN_CITY_NAME", "CANCELLED" from flights1 join flights2 using (id)
         where "CANCELLED" = 1 and "DEST" = '2-HIGH' and year(strptime("FL_DATE", '%m/%d/%Y')) = 2000""",
)
def j01(t: Tables):
    times = s.flights1(t).withColumn("FL_DATE", F.try_to_timestamp("FL_DATE", F.lit("M/d/yyyy")))
    places = s.flights2(t).where((c("CANCELLED") == 1) & (c("DEST") == "2-HIGH"))
    return (
        times.where(F.year("FL_DATE") == 2000)
        .join(places, "id", "inner")
        .orderBy(c("FL_DATE").desc(), "id")
        .select(
            "id", "DEST", "DEST_CITY_NAME", F.date_format("FL_DATE", "yyyy-MM-dd").alias("FL_DATE"),
            "ORIGIN", "ORIGIN_CITY_NAME", "CANCELLED",
        )
    )


@query(
    "j01_cancelled_by_destination_year",
    s.with_("flights1", "flights2")
    + """select "DEST", cast(year(strptime("FL_DATE", '%m/%d/%Y')) as integer) as "FL_YEAR", count(*) as "NUM_CANCELLED_FLIGHT"
         from flights1 join flights2 using (id) where "CANCELLED" = 1 group by 1, 2""",
)
def j01_years(t: Tables):
    times = s.flights1(t).select("id", F.year(F.try_to_timestamp("FL_DATE", F.lit("M/d/yyyy"))).alias("FL_YEAR"))
    return (
        times.join(s.flights2(t).where(c("CANCELLED") == 1), "id")
        .groupBy("DEST", "FL_YEAR")
        .agg(F.count("*").alias("NUM_CANCELLED_FLIGHT"))
        .orderBy("DEST", "FL_YEAR")
    )


@query(
    "j02_inner_on_names_count",
    s.with_("movie", "genre")
    + "select genre, count(*) as movie_count from genre join movie on movie.id = genre.movie_id group by genre",
)
def j02(t: Tables):
    return (
        s.genre(t)
        .join(s.movie(t), c("id") == c("movie_id"))
        .groupBy("genre")
        .agg(F.count("*").alias("movie_count"))
    )


@query(
    "j03_multiway_top_actors",
    s.with_("ratings", "role_mapping", "names")
    + """select * from (select name as actor, count(*) as movie_count,
             cast(dense_rank() over (order by count(*) desc) as integer) as movie_rank
         from ratings join role_mapping on role_mapping.movie_id = ratings.movie_id join names on names.id = role_mapping.name_id
         where median_rating >= 6 and category = 'actor' group by name) where movie_rank <= 2""",
)
def j03(t: Tables):
    liked = s.ratings(t).where(c("median_rating") >= 6).select(c("movie_id").alias("rated"))
    # count per person before the names are joined: a busy person is one row there
    roles = (
        s.role_mapping(t)
        .where(c("category") == "actor")
        .join(liked, c("movie_id") == c("rated"))
        .groupBy("name_id")
        .agg(F.count("*").alias("n"))
    )
    counted = (
        roles.join(s.names(t), c("name_id") == c("id"))
        .groupBy(c("name").alias("actor"))
        .agg(F.sum("n").alias("movie_count"))
    )
    return dense_top_k(counted, "movie_count", 2, name="movie_rank")


@query(
    "j03_vendor_parts_bridge",
    """select s_name as vendor_name, p_name as part_name, count(*) as parts
       from supplier join (select distinct l_suppkey, l_partkey from lineitem) on s_suppkey = l_suppkey
       join part on p_partkey = l_partkey group by 1, 2""",
)
def j03_bridge(t: Tables):
    bridge = t.lineitem.select("l_suppkey", "l_partkey").distinct()
    return (
        bridge.join(t.supplier, c("l_suppkey") == c("s_suppkey"))
        .join(t.part, c("l_partkey") == c("p_partkey"))
        .groupBy(c("s_name").alias("vendor_name"), c("p_name").alias("part_name"))
        .agg(F.count("*").alias("parts"))
    )


@query(
    "j04_left_star_with_defaults",
    """select o_orderkey, coalesce(c_name, 'XNA') as customer_name, coalesce(n_name, 'XNA') as nation_name,
              coalesce(r_name, 'XNA') as region_name
       from orders left join (select * from customer where c_acctbal >= 0) c on o_custkey = c_custkey
       left join (select * from nation where n_nationkey <> 3) n on c_nationkey = n_nationkey
       left join region on n_regionkey = r_regionkey""",
)
def j04(t: Tables):
    unknown = F.lit("XNA")
    return (
        t.orders.join(t.customer.where(c("c_acctbal") >= 0), c("o_custkey") == c("c_custkey"), "left")
        .join(t.nation.where(c("n_nationkey") != 3), c("c_nationkey") == c("n_nationkey"), "left")
        .join(t.region, c("n_regionkey") == c("r_regionkey"), "left")
        .select(
            "o_orderkey",
            F.coalesce("c_name", unknown).alias("customer_name"),
            F.coalesce("n_name", unknown).alias("nation_name"),
            F.coalesce("r_name", unknown).alias("region_name"),
        )
    )


@query(
    "j05_currency_lookup",
    s.with_("fx")
    + """select code, count(*) as rows, round(cast(sum(cast(round(l_extendedprice * exchange_rate, 4) as decimal(28,4))) as double), 2) as usd
         from (select *, case l_linenumber when 1 then '€' when 2 then '$' when 3 then 'CHF' when 4 then '₫' when 5 then 'kr' else '??' end as currency from lineitem)
         join fx on symbol = currency group by code""",
)
def j05(t: Tables):
    symbol = s.pick(c("l_linenumber") - 1, "€", "$", "CHF", "₫", "kr", "??", "??")
    usd = F.round(c("l_extendedprice") * c("exchange_rate"), 4).cast("decimal(28,4)")
    return (
        t.lineitem.withColumn("currency", symbol)
        .join(exchange_rates(t.spark), c("currency") == c("symbol"))
        .groupBy("code")
        .agg(F.count("*").alias("rows"), F.round(F.sum(usd).cast("double"), 2).alias("usd"))
    )


_TOP_GENRES_SQL = """praised as (select movie_id from ratings r semi join movie m on m.id = r.movie_id where avg_rating > 8),
  hits as (select genre, count(*) as n from genre semi join praised using (movie_id) group by all),
  popular as (select genre from hits where n >= (select min(n) from (select distinct n from hits order by n desc limit 3)))"""


def _top_genres(t: Tables):
    rated = s.ratings(t).where(c("avg_rating") > 8).select(c("movie_id").alias("rated"))
    counts = s.genre(t).join(rated, c("movie_id") == c("rated")).groupBy("genre").agg(F.count("*").alias("n"))
    return dense_top_k(counts, "n", 3).select("genre")


@query(
    "j06_semi_top_genre_directors",
    s.with_("movie", "genre", "ratings", "names", "director_mapping")
    + ", "
    + _TOP_GENRES_SQL
    + """, films as (select movie_id, count(*) as n from genre semi join popular using (genre) group by all),
         directed as (select p.name, cast(sum(f.n) as bigint) as movie_count
                      from films f join director_mapping d on d.movie_id = f.movie_id join names p on p.id = d.name_id group by all)
         select name, movie_count, cast(dense_rank() over (order by movie_count desc) as integer) as movie_rank from directed qualify movie_rank <= 3""",
)
def j06(t: Tables):
    """As coded: only the genres are limited to well-rated movies."""
    films = s.genre(t).join(_top_genres(t), "genre", "left_semi").select(c("movie_id").alias("film"))
    per_director = (
        s.director_mapping(t)
        .join(films, c("movie_id") == c("film"))
        .groupBy("name_id")
        .agg(F.count("*").alias("n"))
    )
    counted = (
        per_director.join(s.names(t), c("name_id") == c("id")).groupBy("name").agg(F.sum("n").alias("movie_count"))
    )
    return dense_top_k(counted, "movie_count", 3, name="movie_rank")


@query(
    "j06_intent_directors_own_hits",
    s.with_("movie", "genre", "ratings", "names", "director_mapping")
    + ", "
    + _TOP_GENRES_SQL
    + """, films as (select distinct movie_id from genre semi join popular using (genre)),
         directed as (select p.name, count(*) as movie_count from director_mapping d semi join films f on f.movie_id = d.movie_id
                      join ratings r on r.movie_id = d.movie_id join names p on p.id = d.name_id where r.avg_rating > 8 group by all)
         select name, movie_count, cast(dense_rank() over (order by movie_count desc) as integer) as movie_rank from directed qualify movie_rank <= 3""",
)
def j06_intent(t: Tables):
    """As documented: movies of the top genres that themselves rate above 8, each counted once."""
    rated = s.ratings(t).where(c("avg_rating") > 8).select(c("movie_id").alias("rated"))
    films = s.genre(t).join(_top_genres(t), "genre", "left_semi").select(c("movie_id").alias("film"))
    per_director = (
        s.director_mapping(t)
        .join(rated, c("movie_id") == c("rated"), "left_semi")
        .join(films, c("movie_id") == c("film"), "left_semi")
        .groupBy("name_id")
        .agg(F.count("*").alias("n"))
    )
    counted = (
        per_director.join(s.names(t), c("name_id") == c("id")).groupBy("name").agg(F.sum("n").alias("movie_count"))
    )
    return dense_top_k(counted, "movie_count", 3, name="movie_rank")


@query(
    "j07_anti_absent_keys",
    """select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_orderdate >= timestamp '1998-01-01')""",
)
def j07(t: Tables):
    recent = t.orders.where(c("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return t.customer.join(recent, c("c_custkey") == c("o_custkey"), "left_anti").select("c_custkey", "c_name")


s.CTE["jobs"] = """
select p_partkey as id,
       case p_partkey % 6 when 0 then p_size || ' - ' || (p_size + 10) || ' triệu' when 1 then 'tới ' || (p_size + 10) || ' triệu'
            when 2 then 'Trên ' || p_size || ' triệu' when 3 then 'Tới ' || (p_size % 9 + 1) || ',' || '500 USD'
            when 4 then 'Thoả thuận' else (p_size * 100) || ' - ' || (p_size * 100 + 500) || ' USD' end as salary,
       case p_partkey % 7 when 0 then 'Hà Nội: Ba Đình' when 1 then 'Hồ Chí Minh: Quận 1, Quận 3' when 2 then 'Đà Nẵng'
            when 3 then 'Thừa Thiên Huế: TP Huế' when 4 then 'Toàn Quốc' when 5 then 'Hà Nội: Cầu Giấy,Ba Đình: Đà Nẵng'
            else p_name end as address,
       case p_type when 'ECONOMY' then 'Lập trình viên ' || p_brand when 'PROMO' then 'Data Scientist'
            when 'LARGE' then 'Sales Executive' when 'SMALL' then 'HR Manager' when 'MEDIUM' then 'Nhân viên Thiết Kế'
            else 'Kế toán ' || p_name end as job_title
from part"""


def jobs(t: Tables):
    """Job postings: salary, address and title texts in the styles of the originals."""
    size = c("p_size")

    def words(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    return t.part.select(
        c("p_partkey").alias("id"),
        s.pick(
            c("p_partkey"),
            words(size, " - ", size + 10, " triệu"),
            words("tới ", size + 10, " triệu"),
            words("Trên ", size, " triệu"),
            words("Tới ", size % 9 + 1, ",500 USD"),
            "Thoả thuận",
            words(size * 100, " - ", size * 100 + 500, " USD"),
        ).alias("salary"),
        s.pick(
            c("p_partkey"),
            "Hà Nội: Ba Đình",
            "Hồ Chí Minh: Quận 1, Quận 3",
            "Đà Nẵng",
            "Thừa Thiên Huế: TP Huế",
            "Toàn Quốc",
            "Hà Nội: Cầu Giấy,Ba Đình: Đà Nẵng",
            c("p_name"),
        ).alias("address"),
        F.when(c("p_type") == "ECONOMY", words("Lập trình viên ", c("p_brand")))
        .when(c("p_type") == "PROMO", "Data Scientist")
        .when(c("p_type") == "LARGE", "Sales Executive")
        .when(c("p_type") == "SMALL", "HR Manager")
        .when(c("p_type") == "MEDIUM", "Nhân viên Thiết Kế")
        .otherwise(words("Kế toán ", c("p_name")))
        .alias("job_title"),
    )


def admin_units(spark):
    """A few administrative units: district, city."""
    rows = [("Ba Đình", "Hà Nội"), ("Cầu Giấy", "Hà Nội"), ("Quận 1", "Hồ Chí Minh"), ("Quận 3", "Hồ Chí Minh"),
            ("Hải Châu", "Đà Nẵng"), ("Phú Vang", "Huế")]
    return literal_rows(spark, rows, "district string, city string")


s.CTE["tagged"] = """
select id, case id % 7 when 0 then 'Hà Nội' when 1 then 'Hồ Chí Minh' when 2 then 'Đà Nẵng' when 3 then 'Huế'
                  when 4 then 'Toàn Quốc' when 5 then 'Hà Nội, Đà Nẵng' end as city,
       case id % 7 when 0 then 'Ba Đình' when 1 then 'Quận 1' when 5 then 'Ba Đình, Cầu Giấy' end as district
from jobs"""


@query("j08_address_tagging", s.with_("jobs", "tagged") + "select id, city, district from tagged")
def j08(t: Tables):
    """' Quận 3' keeps its blank after the comma and so stays unmatched, as in the original."""
    names = j.admin_names(admin_units(t.spark), "district", "city")
    return j.tag_addresses(jobs(t), "id", "address", names)


@query(
    "j09_overlapping_intervals",
    """with spans as (select l_orderkey, min(cast(l_shipdate as date)) as lo, max(cast(l_shipdate as date)) as hi from lineitem group by 1),
            starts as (select lo as d, count(*) as n from spans group by 1), ends as (select hi as d, count(*) as n from spans group by 1),
            days as (select distinct cast(o_orderdate as date) as day from orders)
       select strftime(day, '%Y-%m-%d') as day,
              cast(coalesce((select sum(n) from starts where d <= day), 0) - coalesce((select sum(n) from ends where d < day), 0) as bigint) as overlaps
       from days""",
)
def j09(t: Tables):
    spans = t.lineitem.groupBy("l_orderkey").agg(
        F.unix_date(F.to_date(F.min("l_shipdate"))).alias("lo"), F.unix_date(F.to_date(F.max("l_shipdate"))).alias("hi")
    )
    days = t.orders.select(F.unix_date(F.to_date("o_orderdate")).alias("day"))
    counts = j.overlap_counts(spans, "lo", "hi", days, "day")
    return counts.select(
        F.date_format(F.date_from_unix_date(c("day").cast("int")), "yyyy-MM-dd").alias("day"), "overlaps"
    )


@query(
    "j09_open_and_inverted",
    """with spans as (select case when o_orderkey % 7 <> 0 then o_custkey end as lo,
                             case when o_orderkey % 5 <> 0 then o_custkey + o_orderkey % 40 - 10 end as hi from orders)
       select c_custkey as place, (select count(*) from spans where lo <= c_custkey and c_custkey <= hi) as overlaps from customer""",
)
def j09_open(t: Tables):
    """Intervals without a start or an end, and some that end before they start, hold nothing."""
    key, order = c("o_custkey"), c("o_orderkey")
    spans = t.orders.select(
        F.when(order % 7 != 0, key).alias("lo"), F.when(order % 5 != 0, key + order % 40 - 10).alias("hi")
    )
    return j.overlap_counts(spans, "lo", "hi", t.customer.select(c("c_custkey").cast("bigint").alias("place")), "place")


def event_ip():
    """An address per event, from its user and its number."""
    parts = [c("user_id") % 223 + 1, c("user_id") % 256, c("event_id") % 16, c("event_id") % 8]
    return F.concat_ws(".", *[p.cast("string") for p in parts])


EVENT_IP_SQL = "concat_ws('.', user_id % 223 + 1, user_id % 256, event_id % 16, event_id % 8)"


def ip_ranges(spark):
    """64 ranges by rule: the first half of every run of four first bytes; the rest is unassigned."""
    size = 1 << 24
    return spark.range(64).select(
        (c("id") * 4 * size).alias("ip_from"),
        (c("id") * 4 * size + 2 * size - 1).alias("ip_to"),
        F.concat(F.lit("C"), (c("id") % 10).cast("string")).alias("country_short"),
        F.concat(F.lit("City "), c("id").cast("string")).alias("city"),
    )


@query(
    "j10_ip_location",
    f"""select ip, case when user_id % 223 % 4 in (3, 0) then 'C' || ((user_id % 223 + 1) // 4 % 10) end as country_short,
              case when user_id % 223 % 4 in (3, 0) then 'City ' || ((user_id % 223 + 1) // 4) end as city
        from (select distinct {EVENT_IP_SQL} as ip, user_id from events)""",
)
def j10(t: Tables):
    addresses = t.events.select(event_ip().alias("ip"))
    return j.locate_ips(addresses, "ip", ip_ranges(t.spark), ["country_short", "city"])


def _batches(t: Tables):
    base = t.orders.select(c("o_orderpriority").alias("batch"), c("o_custkey").alias("key"), "o_orderstatus", "o_orderkey")
    name = F.when(c("o_orderkey") % 3 == 0, "fail").otherwise("ok").alias("name")
    return base.select("batch", "key"), base.where(c("o_orderstatus") != "P").select("batch", "key", name)


s.CTE["sent"] = "select o_orderpriority as batch, o_custkey as key from orders"
s.CTE["received"] = """select o_orderpriority as batch, o_custkey as key, case when o_orderkey % 3 = 0 then 'fail' else 'ok' end as name
from orders where o_orderstatus <> 'P'"""


@query(
    "j11_batch_reconciliation",
    s.with_("sent", "received")
    + """select batch, inp_rows, inp_keys, oup_rows, oup_success_rows, oup_keys from
         (select batch, count(*) as inp_rows, count(distinct key) as inp_keys from sent group by 1) full join
         (select batch, count(*) as oup_rows, cast(count(*) filter (name <> 'fail') as bigint) as oup_success_rows,
                 count(distinct key) filter (name <> 'fail') as oup_keys from received group by 1) using (batch)""",
)
def j11(t: Tables):
    sent, received = _batches(t)
    return j.batch_report(sent, received, "batch", "key", c("name") != "fail")


@query(
    "j11_missing_keys",
    s.with_("sent", "received") + "select batch, key from sent except select batch, key from received where name <> 'fail'",
)
def j11_missing(t: Tables):
    sent, received = _batches(t)
    return j.missing_keys(sent, received, "batch", "key", c("name") != "fail")
