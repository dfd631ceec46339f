"""Rows that the given tables do not hold: missing ends, fine values, broken documents, repeated changes."""

import pytest
from pyspark.sql import functions as F

from larkspur.functions import nested
from larkspur.operators import aggregates, mutation, relational, warehouse
from larkspur.operators.joins import overlap_counts
from larkspur.session import new_folder
from larkspur.sources import writers


def test_open_and_inverted_intervals_hold_nothing(spark):
    days = spark.createDataFrame([(3,), (5,), (20,)], "d int")

    def counts(spans):
        df = overlap_counts(spark.createDataFrame(spans, "lo int, hi int"), "lo", "hi", days, "d")
        return {r["d"]: r["overlaps"] for r in df.collect()}

    assert counts([(1, None), (10, 3), (2, 4), (None, 9)]) == {3: 1, 5: 0, 20: 0}
    assert counts([(10, 3)]) == {3: 0, 5: 0, 20: 0}


@pytest.mark.parametrize("values", [(0.00001, 0.00003), (1e25, 3e25)])
def test_means_of_any_size(spark, values):
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    assert [r["above_mean"] for r in aggregates.above_group_mean(df, "g", "v").orderBy("v").collect()] == [False, True]


def test_unreadable_documents_and_long_numbers_are_profiled(spark):
    docs = ['{"a": 1', '{"a": 99999999999999999999}', '{"a": 1.5}', None, '{"a": null}']
    df = spark.createDataFrame([("x", d) for d in docs], "label string, doc string")
    profile = nested.type_profile(df, "doc", "label")
    got = {(r["path"], r["type"]): r["n"] for r in profile.collect()}
    assert got == {("", "unreadable"): 1, ("a", "int"): 1, ("a", "float"): 1, ("a", "NoneType"): 1}
    assert nested.target_schema(profile).fieldNames() == ["a"]


def test_unlisted_methods_come_last(spark):
    rows = [(1, "u", "a", "other"), (1, "u", "b", "second"), (2, "u", "c", "other")]
    df = spark.createDataFrame(rows, "k int, url string, name string, method string")
    got = warehouse.first_success(df, "k", ["first", "second"]).collect()
    assert {r["k"]: r["name"] for r in got} == {1: "b", 2: "c"}


def test_unknown_member_of_any_type(spark):
    df = spark.createDataFrame([(1, "a", 2.5, True)], "k int not null, name string, price double, flag boolean")
    assert {tuple(r) for r in relational.with_unknown_member(df, "k", -1).collect()} == {(1, "a", 2.5, True), (-1, "XNA", None, None)}


def test_repeated_changes_leave_one_row(spark):
    target = spark.createDataFrame([(1, "old", 0), (2, "old", 0)], "id int, name string, v int")
    changes = spark.createDataFrame([(1, "late", 2), (1, "early", 1), (3, "b", 1), (3, "a", 1)], "id int, name string, v int")
    got = mutation.upsert(target, changes, ["id"], -F.col("v")).collect()
    assert sorted(map(tuple, got)) == [(1, "late", 2), (2, "old", 0), (3, "a", 1)]


def test_csv_without_target_columns(spark):
    source, target = new_folder(spark, "raw"), new_folder(spark, "typed")
    writers.write_csv(spark.createDataFrame([("x", 1)], "b string, a int"), source)
    from pyspark.sql import types as T

    writers.convert_csv(spark, source, target, T.DataType.fromDDL("a bigint, b int, c string"))
    assert [tuple(r) for r in spark.read.parquet(target).collect()] == [(1, None, None)]


def test_a_table_is_replaced_in_place(spark):
    name = mutation.unique_name("swap")
    mutation.replace_table(spark.range(3), name)
    mutation.replace_table(spark.table(name).where("id > 0"), name)
    assert sorted(r["id"] for r in spark.table(name).collect()) == [1, 2]
    mutation.replace_table(spark.table(name).select(F.col("id").cast("string").alias("key")), name)
    assert sorted(r["key"] for r in spark.table(name).collect()) == ["1", "2"]


def test_second_extremes_and_box_plot_of_small_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0), ("b", 5.0), (None, 1.0), (None, 3.0), ("c", None)], "g string, v double")
    got = {tuple(r) for r in aggregates.second_extremes(df, "g", "v").collect()}
    assert got == {("b", 5.0, 2.0), (None, 3.0, 1.0)}
    box = {r["g"]: (r["q1"], r["median"], r["q3"], r["whisker_low"], r["whisker_high"]) for r in aggregates.box_plot(df, ["g"], "v").collect()}
    assert box == {"a": (1, 1, 1, 1, 1), "b": (2.75, 3.5, 4.25, 2, 5), None: (1.5, 2, 2.5, 1, 3)}
