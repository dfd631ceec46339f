"""Rankings and percentiles with many value ranges, against brute force."""

import datetime
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.operators import mutation, ordered
from larkspur.operators.joins import overlap_counts


@pytest.fixture(scope="module")
def skewed(spark):
    """Group 'hot' has a third of the rows, one value of it half of those; some values are missing."""
    rng = random.Random(7)
    data = []
    for i in range(900):
        group = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"g{i % 7}")
        value = 5.0 if group == "hot" and i % 2 else float(rng.randint(-50, 50)) / 2
        data.append((i, group, None if i % 41 == 0 else value))
    frame = pd.DataFrame(data, columns=["id", "g", "v"])
    return frame, spark.createDataFrame(data, "id int, g string, v double")


@pytest.mark.parametrize("size", [None, 7, 40])
@pytest.mark.parametrize("dense", [True, False])
@pytest.mark.parametrize("descending", [True, False])
def test_with_rank(skewed, size, dense, descending):
    frame, df = skewed
    method = "dense" if dense else "min"
    want = frame.groupby("g", dropna=False)["v"].rank(method=method, ascending=not descending, na_option="bottom").astype(int)
    got = ordered.with_rank(df, "v", ["g"], "r", dense, descending, size)
    assert {r["id"]: r["r"] for r in got.collect()} == dict(zip(frame["id"], want))


@pytest.mark.parametrize("size", [None, 5])
def test_rank_without_groups(skewed, size):
    frame, df = skewed
    want = frame["v"].rank(method="dense", ascending=False, na_option="bottom").astype(int)
    got = ordered.with_rank(df, "v", name="r", dense=True, ranges=size)
    assert {r["id"]: r["r"] for r in got.collect()} == dict(zip(frame["id"], want))


@pytest.mark.parametrize("size", [None, 6])
def test_exact_percentiles(skewed, size):
    frame, df = skewed
    quantiles = {"q1": 0.25, "m": 0.5, "p90": 0.9}
    got = ordered.exact_percentiles(df, "v", quantiles, ["g"], size).collect()
    groups = frame.fillna({"g": "none"}).dropna(subset=["v"]).groupby("g")["v"]
    assert len(got) == groups.ngroups
    for row in got:
        for name, q in quantiles.items():
            assert row[name] == pytest.approx(groups.get_group(row["g"] or "none").quantile(q))


@pytest.mark.parametrize("ranges", [None, 1, 6])
def test_percentiles_between_infinities(spark, ranges):
    inf = math.inf
    df = spark.createDataFrame([("a", -inf), ("a", 2.0), ("b", -inf), ("b", inf), ("c", 2.0), ("c", inf), ("d", -inf)], "g string, v double")
    got = {r["g"]: r["m"] for r in ordered.exact_percentiles(df, "v", {"m": 0.5}, ["g"], ranges).collect()}
    assert got["a"] == -inf and math.isnan(got["b"]) and got["c"] == inf and got["d"] == -inf


@pytest.mark.parametrize("ranges", [None, 5])
@pytest.mark.parametrize("kind, values", [
    ("date", [datetime.date(2020, 1, d) for d in (3, 1, 3, 9)] + [None]), ("string", ["b", "a", "b", "", None]),
    ("double", [math.nan, 1.0, math.inf, -math.inf, None, math.nan]),
])
def test_rank_of_any_type_keeps_nulls(spark, ranges, kind, values):
    df = spark.createDataFrame(list(enumerate(values)), f"id int, v {kind}")
    for last in (True, False):
        w = Window.orderBy(F.col("v").desc_nulls_last() if last else F.col("v").desc_nulls_first())
        want = {r["id"]: r["r"] for r in df.withColumn("r", F.rank().over(w)).collect()}
        got = ordered.with_rank(df, "v", name="r", ranges=ranges, nulls_last=last).collect()
        assert {r["id"]: r["r"] for r in got} == want and len(got) == len(values)


def test_percentiles_skip_nan_and_keep_infinity(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("a", math.nan), ("a", None), ("b", 1.0), ("b", math.inf), ("b", math.inf)],
        "g string, v double",
    )
    got = {r["g"]: r["m"] for r in ordered.exact_percentiles(df, "v", {"m": 0.5}, ["g"]).collect()}
    assert got == {"a": 1.5, "b": math.inf}


@pytest.mark.parametrize("gathered", [None, 1, 20])
def test_percentiles_of_any_doubles(spark, gathered):
    """Values side by side, of every size and sign, zeros of both signs, and one value with a third of all rows."""
    rng = random.Random(3)
    close = [1.0]
    for _ in range(60):
        close.append(math.nextafter(close[-1], 2))
    wide = [rng.choice((-1, 1)) * rng.random() * 2.0 ** rng.randint(-1074, 1020) for _ in range(301)]
    groups = {
        "close": close, "wide": wide, "tiny": [5e-324 * i for i in range(-40, 41)], "zeros": [0.0, -0.0, 0.0, 1.0],
        "whole": [float(i) for i in range(10**15, 10**15 + 3000)], "hot": [7.25] * 500 + [rng.gauss(0, 1e6) for _ in range(1000)],
        "ends": [math.inf, -math.inf, *wide[:9]], "one": [3.0], None: [2.0, 4.0],
    }
    df = spark.createDataFrame([(g, v) for g, values in groups.items() for v in values], "g string, v double").repartition(5)
    quantiles = {"low": 0.0, "q1": 0.25, "m": 0.5, "p90": 0.9, "high": 1.0}
    got = {r["g"]: r for r in ordered.exact_percentiles(df, "v", quantiles, ["g"], gathered).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        values = sorted(values)
        for name, q in quantiles.items():
            at = (len(values) - 1) * q
            low, high, f = values[math.floor(at)], values[math.ceil(at)], at - math.floor(at)
            want = low if low == high or not f else (1 - f) * low + f * high
            assert got[g][name] == want, (g, name)


def test_percentiles_of_nothing(spark):
    none = spark.createDataFrame([("a", None)], "g string, v double")
    assert ordered.exact_percentiles(none, "v", {"m": 0.5}, ["g"]).collect() == []
    assert [tuple(r) for r in ordered.exact_percentiles(none, "v", {"m": 0.5}).collect()] == [(None,)]


def test_percentiles_write_no_sorted_copy(spark):
    """Neither a sort by ranges nor a window over rows of the input."""
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 1.5).alias("v"))
    plan = ordered.exact_percentiles(df, "v", {"m": 0.5}, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_dense_top_k_keeps_all_ties(skewed):
    frame, df = skewed
    frame = frame.dropna(subset=["v"])
    ranks = frame.groupby("g", dropna=False)["v"].rank(method="dense", ascending=False)
    want = {(i, int(r)) for i, r in zip(frame["id"], ranks) if r <= 2}
    assert {(r["id"], r["r"]) for r in ordered.dense_top_k(df, "v", 2, ["g"], "r").collect()} == want
    overall = frame["v"].rank(method="dense", ascending=False)
    want = {(i, int(r)) for i, r in zip(frame["id"], overall) if r <= 3}
    for top in (ordered.dense_top_k, ordered.dense_top_rows):
        assert {(r["id"], r["r"]) for r in top(df, "v", 3, name="r").collect()} == want


@pytest.mark.parametrize("size", [None, 9])
def test_running_sums(spark, size):
    data = [(g, i, (i * 7) % 11) for g in ("a", "b") for i in range(50) if (g, i) != ("b", 3)]
    df = spark.createDataFrame(data, "g string, i bigint, x bigint")
    frame = pd.DataFrame(data, columns=["g", "i", "x"])
    frame["before"] = frame.groupby("g")["x"].cumsum() - frame["x"]
    frame["total"] = frame.groupby("g")["x"].transform("sum")
    got = ordered.running_sums(df, ["g"], "i", ["x"], size).select("g", "i", "x", "x_before", "x_total")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, frame.to_numpy().tolist()))


def test_overlap_counts(spark):
    rng = random.Random(3)
    spans = [(lo, lo + rng.randint(0, 40)) for lo in (rng.randint(-20, 100) for _ in range(200))]
    days = sorted({rng.randint(-30, 150) for _ in range(60)})
    got = overlap_counts(
        spark.createDataFrame(spans, "lo int, hi int"), "lo", "hi", spark.createDataFrame([(d,) for d in days * 2], "d int"), "d"
    )
    want = {d: sum(lo <= d <= hi for lo, hi in spans) for d in days}
    assert {r["d"]: r["overlaps"] for r in got.collect()} == want


def test_overlap_counts_samples(spark):
    def count(events, day):
        df = overlap_counts(
            spark.createDataFrame(events, "lo int, hi int"), "lo", "hi", spark.createDataFrame([(day,)], "d int"), "d"
        )
        return df.first()["overlaps"]

    assert count([(29, 31), (23, 26), (24, 25)], 24) == 2
    assert count([(1, 4), (7, 10), (8, 8), (14, 23)], 26) == 0


def test_new_ids_run_on_across_ranges(spark):
    target = spark.createDataFrame([(41, "x"), (7, "y")], "id bigint, name string")
    rows = spark.createDataFrame([(k, f"n{k}") for k in np.random.default_rng(0).permutation(60).tolist()], "k int, name string")
    got = mutation.insert_with_ids(target, rows, "id", F.col("k")).collect()
    assert {r["k"]: r["id"] for r in got} == {k: 42 + k for k in range(60)}


@pytest.mark.parametrize("ranges", [1, 7])
def test_carried_values_cross_ranges(spark, ranges):
    rows = [(i, i * 10 if i % 37 == 5 else None, "x" if i == 50 else None, 1) for i in range(300)]
    df = spark.createDataFrame(rows, "at int, mark int, once string, _r int").repartition(5)
    got = {r["at"]: (r["last_mark"], r["last_once"]) for r in ordered.carried(df, ["at"], {"last_mark": F.col("mark"), "last_once": F.col("once")}, ranges).collect()}
    mark = once = None
    for at, m, o, _ in rows:
        mark, once = (mark if m is None else m), (once if o is None else o)
        assert got[at] == (mark, once)
    empty = ordered.carried(df.where("at < 0"), ["at"], {"last_mark": F.col("mark")}, ranges)
    assert empty.collect() == []
