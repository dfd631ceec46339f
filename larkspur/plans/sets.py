"""Set operations on rows and arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.operators.mutation import one_per_key
from larkspur.plans.registry import Tables, query

c = F.col


@query("u01_union_distinct", "select n_name as name from nation union select c_name from customer union select s_name from supplier union select n_name from nation")
def u01(t: Tables):
    nations = t.nation.select(c("n_name").alias("name"))
    return nations.union(t.customer.select("c_name")).union(t.supplier.select("s_name")).union(nations).distinct()


@query(
    "u02_union_all",
    """select c_nationkey as nationkey, c_acctbal as balance from customer union all select s_nationkey, s_acctbal from supplier""",
)
def u02(t: Tables):
    customers = t.customer.select(c("c_nationkey").alias("nationkey"), c("c_acctbal").alias("balance"))
    suppliers = t.supplier.select(c("s_acctbal").alias("balance"), c("s_nationkey").alias("nationkey"))
    return customers.unionByName(suppliers)


@query("u03_except_new_values", "select o_custkey as custkey from orders except select c_custkey from customer where c_acctbal > 1000")
def u03(t: Tables):
    known = t.customer.where(c("c_acctbal") > 1000).select(c("c_custkey").alias("custkey"))
    return t.orders.select(c("o_custkey").alias("custkey")).subtract(known)


@query("u04_whole_row_distinct", "select distinct l_linenumber, l_quantity, l_returnflag, l_linestatus from lineitem")
def u04(t: Tables):
    return t.lineitem.select("l_linenumber", "l_quantity", "l_returnflag", "l_linestatus").distinct()


@query(
    "u05_distinct_on_key",
    """select o_custkey, o_orderkey, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_orderkey) = 1""",
)
def u05(t: Tables):
    return one_per_key(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], c("o_orderkey"))


def _name_arrays(t: Tables):
    return t.part.select(
        "p_partkey",
        F.split("p_name", " ").alias("current"),
        F.array(c("p_type"), c("p_brand"), F.split_part("p_name", F.lit(" "), F.lit(1))).alias("extra"),
    )


@query(
    "u06_array_union",
    """select p_partkey, array_to_string(list_sort(list_distinct(list_concat(string_split(p_name, ' '), [p_type, p_brand, split_part(p_name, ' ', 1)]))), ',') as members from part""",
)
def u06(t: Tables):
    return _name_arrays(t).select(
        "p_partkey", F.array_join(F.array_sort(F.array_union("current", "extra")), ",").alias("members")
    )


@query(
    "u06_recruit_above_mean",
    """select p_partkey, concat_ws(',', p_size, (p_partkey % 50), case when (p_partkey % 60) > m0 then p_partkey % 60 end,
              case when (p_partkey % 70) > case when (p_partkey % 60) > m0 then (m0 * 2 + p_partkey % 60) / 3 else m0 end then p_partkey % 70 end) as members
       from (select *, (p_size + p_partkey % 50) / 2.0::double as m0 from part)""",
)
def u06_recruit(t: Tables):
    """A newcomer joins if they beat the mean of the members so far, including earlier newcomers."""
    size, key = c("p_size").cast("bigint"), c("p_partkey")
    start, newcomers = F.array(size, key % 50), F.array(key % 60, key % 70)

    def join_if_above(members, x):
        total = F.aggregate(members, F.lit(0).cast("bigint"), lambda acc, m: acc + m)
        return F.when(x * F.size(members) > total, F.array_append(members, x)).otherwise(members)

    members = F.aggregate(newcomers, start, join_if_above)
    return t.part.select("p_partkey", F.array_join(members.cast("array<string>"), ",").alias("members"))


@query(
    "u07_array_distinct_in_order",
    """select doc_id, array_to_string(list_transform(list_sort(list_transform(list_distinct(words), lambda w: list_position(words, w))), lambda i: words[i]), ' ') as words
       from (select doc_id, string_split(text, ' ') as words from documents)""",
)
def u07(t: Tables):
    return t.spread("documents", "doc_id", "text").select("doc_id", F.array_join(F.array_distinct(F.split("text", " ")), " ").alias("words"))
