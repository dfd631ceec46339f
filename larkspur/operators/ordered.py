"""Order statistics that hold when one group, or one value, has a large share of the rows.

A window sorts each of its partitions in one task, so a ranking window over raw
rows is as slow as its largest group. Here rows first collapse to one row per
distinct (group, value), with a count. These are range-partitioned on group and value and
written, each partition is summed on its own, and the partitions are joined up by their
totals. Hot values are one row each; hot groups spread over many partitions. There is one
path for every size: a small frame is one range. Percentiles need no order of all rows: histograms
that are refined around the wanted places select them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.session import cut_lineage


def running_sums(
    df: DataFrame, by: Sequence[str], order: str | Column, amounts: Sequence[str], ranges: int | None = None
) -> DataFrame:
    """Sums over the earlier rows of each group, and over the whole group.

    The frame has one row per (by, order), and ``order`` is of any type that sorts, or an
    expression with a direction. For every amount column ``x`` the columns ``x_before`` and
    ``x_total`` are added. The frame is written once, cut by group and order into ``ranges``
    (default: the session's shuffle partitions, small ones merged): no task holds more than one.
    """
    by, amounts = list(by), list(amounts)
    order = F.col(order).asc() if isinstance(order, str) else order
    cut = [ranges] if ranges else []
    ranged = df.repartitionByRange(*cut, *by, order).withColumn("_range", F.spark_partition_id())
    ranged = cut_lineage(df.sparkSession, ranged, "ordered")

    def or_zero(column: Column) -> Column:
        return F.coalesce(column, F.lit(0))

    keys = [f"_{k}" for k in by]
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranged.groupBy(*[F.col(k).alias(f"_{k}") for k in by], F.col("_range").alias("_r"))
        .agg(*[F.sum(x).alias(f"_{x}") for x in amounts])
        .select(
            *keys,
            "_r",
            *[or_zero(F.sum(f"_{x}").over(earlier)).alias(f"_{x}_offset") for x in amounts],
            *[F.sum(f"_{x}").over(whole).alias(f"{x}_total") for x in amounts],
        )
    )
    inside = Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumns({f"_{x}_inside": or_zero(F.sum(x).over(inside)) for x in amounts})
    return placed.join(totals, _same(by) & (F.col("_range") == F.col("_r"))).select(
        *df.columns,
        *[(F.col(f"_{x}_offset") + F.col(f"_{x}_inside")).alias(f"{x}_before") for x in amounts],
        *[f"{x}_total" for x in amounts],
    )


def carried(df: DataFrame, order: Sequence[str], values: dict[str, Column], ranges: int | None = None) -> DataFrame:
    """For every row the last value that is not null, of this row or an earlier one, of each expression.

    The order is over the whole frame and has no ties that matter. The frame is written once, cut by it into ``ranges``
    (default: the session's shuffle partitions): each range is scanned on its own, and what its predecessors end with
    is carried over from one row per range. So no key, however many rows follow it, brings them into one task.
    """
    order = list(order)
    cut = [ranges] if ranges else []
    own = {f"_carry_{name}": value for name, value in values.items()}
    ranged = df.withColumns(own).repartitionByRange(*cut, *order).withColumn("_carry_range", F.spark_partition_id())
    ranged = cut_lineage(df.sparkSession, ranged, "carried")
    place = F.struct(*order)
    ends = ranged.groupBy(F.col("_carry_range").alias("_carry_from")).agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), place)).alias(f"_end{v}") for v in own]
    )
    # one row per range
    earlier = Window.orderBy("_carry_from").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("_carry_from", *[F.last(f"_end{v}", ignorenulls=True).over(earlier).alias(f"_start{v}") for v in own])
    here = Window.partitionBy("_carry_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = ranged.withColumns({f"_here{v}": F.last(v, ignorenulls=True).over(here) for v in own})
    found = {name: F.coalesce(f"_here_carry_{name}", f"_start_carry_{name}") for name in values}
    return scanned.join(starts, F.col("_carry_range") == F.col("_carry_from")).select(*df.columns, *[v.alias(n) for n, v in found.items()])


def _same(by: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by), F.lit(True))


def prefix_counts(
    df: DataFrame, by: Sequence[str], value: str, ranges: int | None = None, order: Column | None = None
) -> DataFrame:
    """One row per distinct (by, value) with its place in the group.

    Columns added: ``rows`` with this value, ``rows_before`` with an earlier value,
    ``values_before`` distinct earlier values, and the group's totals ``rows_total``
    and ``values_total``. A missing value is a value; by default it comes first.
    """
    counted = df.groupBy(*by, value).agg(F.count("*").alias("rows")).withColumn("values", F.lit(1).cast("bigint"))
    return running_sums(counted, by, value if order is None else order, ["rows", "values"], ranges)


def with_rank(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    name: str = "rank",
    dense: bool = False,
    descending: bool = True,
    ranges: int | None = None,
    nulls_last: bool = True,
) -> DataFrame:
    """Every row with its rank (or dense rank) by a value of any type that sorts, within its group.

    Rows without a value share the last rank, or the first with ``nulls_last`` false.
    """
    by = list(by)
    v = F.col(value)
    order = {
        (True, True): v.desc_nulls_last(), (True, False): v.desc_nulls_first(),
        (False, True): v.asc_nulls_last(), (False, False): v.asc_nulls_first(),
    }[descending, nulls_last]
    places = prefix_counts(df, by, value, ranges, order)
    rank = F.col("values_before" if dense else "rows_before") + 1
    lookup = places.select(*[F.col(k).alias(f"_{k}") for k in by], v.alias("_v"), rank.alias(name))
    return df.join(lookup, v.eqNullSafe(F.col("_v")) & _same(by)).drop("_v", *[f"_{k}" for k in by])


def dense_top_k(
    df: DataFrame, value: str, k: int, by: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """Rows whose value is among the ``k`` highest distinct values of their group, ties kept.

    For aggregates, whose top values have few rows: each task passes on its rows of the ``k``
    highest values per group only, and the input is read once.
    """
    order = Window.partitionBy(*by).orderBy(F.col(value).desc())
    return df.where(F.col(value).isNotNull()).withColumn(name, F.dense_rank().over(order)).where(F.col(name) <= k)


def dense_top_rows(
    df: DataFrame, value: str, k: int, by: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """The same for raw rows, where a top value may have a large share of them.

    Only distinct values are ranked; the tied rows themselves are found again by a join on
    the value. The input is used twice, so it is a table or has been written.
    """
    by = list(by)
    values = df.select(*[F.col(b).alias(f"_{b}") for b in by], F.col(value).alias("_v")).distinct()
    top = dense_top_k(values, "_v", k, [f"_{b}" for b in by], name)
    return df.join(top, (F.col(value) == F.col("_v")) & _same(by)).drop("_v", *[f"_{b}" for b in by])


#: Steps of the first histogram for each doubling of a value, and of each cell that is cut again.
OCTAVE_STEPS = 256
CELL_STEPS = 4096
#: Rows of an open cell whose values are counted one by one.
GATHERED = 1 << 16


def exact_percentiles(
    df: DataFrame,
    value: str,
    quantiles: dict[str, float],
    by: Sequence[str] = (),
    gathered: int | None = None,
) -> DataFrame:
    """Exact, linearly interpolated percentiles per group; NULL and NaN values are skipped.

    Selection by histograms: rows are counted in cells along a logarithmic scale, and only cells that hold a
    wanted place are looked at again. A cell with one value is done. If any other has more than ``gathered`` rows, the
    rows of these cells are written and cut into finer cells between their smallest and largest value, all groups
    and places at once; five rounds tell any two doubles apart. The values of what is left are counted. Nothing is
    sorted by ranges, only rows of open cells are written, and a value that a third of the rows hold is a cell of
    its own. The input is read twice or, in long tails, three times: what is costly to derive is better written before. Between an infinity and a number lies that infinity, between the two infinities nothing: NaN.
    """
    spark, by = df.sparkSession, list(by)
    number = F.col(value).cast("double")
    rows = df.select(*by, F.when(~F.isnan(number), number).alias("_x")).where("_x is not null")
    rows = rows.withColumns({"_cell": F.lit(0.0), "_before": F.lit(0).cast("bigint"), "_n": F.lit(None).cast("bigint")})
    code, places = _scale(F.col("_x")), []
    while True:
        cells = cut_lineage(spark, _wanted_cells(rows, by, code, quantiles), "cells")
        places.append(
            cells.where("_lo = _hi").select(
                *by, F.col("_lo").alias("_x"), "rows", F.col("_first").alias("rows_before"), F.col("_total").alias("rows_total")
            )
        )
        open_cells = cells.where("_lo < _hi")
        largest = open_cells.agg(F.max("rows")).first()[0]
        if largest is None:
            break
        rows = _rows_of(rows, by, code, open_cells)
        if largest <= (gathered or GATHERED):
            places.append(_counted_values(rows, by))
            break
        rows = cut_lineage(spark, rows, "open")
        code = F.floor((F.col("_x") - F.col("_cell")) / (F.col("_end") - F.col("_cell")) * CELL_STEPS)
    return percentiles_of(reduce(DataFrame.unionByName, places), "_x", quantiles, by)


def _scale(x: Column) -> Column:
    """A whole number that never falls while a double rises: its sign and its place among the powers of two."""
    size = F.floor(F.log2(F.abs(x)) * OCTAVE_STEPS) + 1100 * OCTAVE_STEPS
    least, most = F.lit(-math.inf), F.lit(math.inf)
    end = F.lit(4096 * OCTAVE_STEPS).cast("bigint")
    return F.when(x == most, end).when(x == least, -end).when(x > 0, size).when(x < 0, -size).otherwise(F.lit(0).cast("bigint"))


def _wanted_cells(rows: DataFrame, by: list[str], code: Column, quantiles: dict[str, float]) -> DataFrame:
    """The cells that hold a place some percentile needs, with ``_lo`` and ``_hi``, and rows in and before them.

    A cell of the last round has no more cells than the scale has steps, so the window over them is bounded.
    """
    counted = (
        rows.withColumn("_code", code)
        .groupBy(*by, "_cell", "_code")
        .agg(
            F.count("*").alias("rows"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"),
            F.max("_before").alias("_before"), F.max("_n").alias("_n"),
        )
    )
    whole = Window.partitionBy(*by, "_cell")
    earlier = whole.orderBy("_code").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumns({
        "_first": F.col("_before") + F.coalesce(F.sum("rows").over(earlier), F.lit(0)),
        "_total": F.coalesce("_n", F.sum("rows").over(whole)),
    })
    wanted = F.lit(False)
    for q in quantiles.values():
        position = (F.col("_total") - 1) * F.lit(float(q))
        for index in (F.floor(position), F.ceil(position)):
            wanted = wanted | ((F.col("_first") <= index) & (index < F.col("_first") + F.col("rows")))
    return placed.where(wanted).select(*by, "_cell", "_code", "_lo", "_hi", "rows", "_first", "_total")


def _rows_of(rows: DataFrame, by: list[str], code: Column, cells: DataFrame) -> DataFrame:
    """The rows that lie in the given cells, each with its cell."""
    own = [*by, "_cell", "_code"]
    found = cells.select(*[F.col(k).alias(f"_of_{k}") for k in own], "_lo", "_hi", "_first", "_total")
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in own))
    return rows.withColumn("_code", code).join(found, on).select(
        *by, "_x", F.col("_lo").alias("_cell"), F.col("_hi").alias("_end"), F.col("_first").alias("_before"), F.col("_total").alias("_n")
    )


def _counted_values(rows: DataFrame, by: list[str]) -> DataFrame:
    """The places of all values in cells that have few rows."""
    counted = rows.groupBy(*by, "_cell", "_before", "_n", "_x").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy(*by, "_cell").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_before") + F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    return counted.select(*by, "_x", "rows", before.alias("rows_before"), F.col("_n").alias("rows_total"))


def percentiles_of(places: DataFrame, value: str, quantiles: dict[str, float], by: Sequence[str]) -> DataFrame:
    """The percentiles from ``rows``, ``rows_before`` and ``rows_total`` of the values, as ``prefix_counts`` has them."""
    picks = []
    for name, q in quantiles.items():
        position = (F.col("rows_total") - 1) * F.lit(float(q))
        for side, index in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (F.col("rows_before") <= index) & (index < F.col("rows_before") + F.col("rows"))
            picks.append(F.max(F.when(here, F.col(value))).alias(f"_{name}_{side}"))
    out = places.groupBy(*by).agg(F.max("rows_total").alias("_n"), *picks)
    for name, q in quantiles.items():
        position = (F.col("_n") - 1) * F.lit(float(q))
        low, high, f = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), position - F.floor(position)
        out = out.withColumn(name, F.when((low == high) | (f == 0), low).otherwise((1 - f) * low + f * high))
    return out.select(*by, *quantiles)
