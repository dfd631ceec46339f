"""Changing tables without MERGE: every change is a new frame, written next to the old one and swapped in."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.session import new_folder


def create_if_absent(spark: SparkSession, name: str, schema: str | T.StructType) -> bool:
    """Create an empty parquet table unless it exists; tells whether it was created."""
    if spark.catalog.tableExists(name):
        return False
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    spark.catalog.createTable(name, path=new_folder(spark, name), source="parquet", schema=schema)
    return True


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to a new folder, then point the table at them in one step.

    The rows may come from the table itself: its old files stay until the new ones are
    complete, and a failed write leaves the table as it was. Only a change of its columns
    takes a new table.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    kept = spark.catalog.tableExists(name)
    if kept and spark.table(name).schema != spark.read.parquet(path).schema:
        spark.sql(f"drop table {name}")
        kept = False
    if kept:
        spark.sql(f"alter table {name} set location '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=path, source="parquet")
    return spark.table(name)


def refresh_table(df: DataFrame, name: str) -> DataFrame:
    """Make the table hold exactly these rows (truncate and insert)."""
    return replace_table(df, name)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def one_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row per key: the first by the given order, and by the remaining columns where that ties.

    The smallest row is found by an aggregate, so most rows are dropped before the shuffle.
    """
    ranks = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    rest = [x for x in df.columns if x not in keys]
    best = df.groupBy(*keys).agg(F.min(F.struct(*ranks, *rest)).alias("_row"))
    return best.select(*keys, *[f"_row.{x}" for x in rest]).select(*df.columns)


def not_yet_stored(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a batch whose key is not in the target.

    First the target's keys are cut down to those of the batch. With a small batch that is
    a broadcast semi join, so the target is read (key columns only) and never shuffled.
    """
    keys = list(keys)
    present = target.select(*keys).join(batch.select(*keys), keys, "left_semi")
    return batch.join(present, keys, "left_anti")


def insert_if_absent(batch: DataFrame, target: DataFrame, keys: Sequence[str], *order: Column, small: bool = False) -> DataFrame:
    """The rows to append so that the first row per key wins, in the batch and against the target.

    Rows with a NULL in the key are left out: a primary key cannot be NULL. Both sides are shuffled by key. Of a
    ``small`` batch (its rows have been counted) the keys may be broadcast instead, so the target stays where it is:
    the planner cannot tell, for it takes a key column of a cached or wide frame for a fraction of its size.
    """
    keys = list(keys)
    keyed = batch.na.drop(subset=keys)
    if small:
        return one_per_key(not_yet_stored(keyed, target, keys), keys, *order)
    return one_per_key(keyed, keys, *order).join(target.select(*keys).hint("merge"), keys, "left_anti")


def insert_with_ids(target: DataFrame, rows: DataFrame, id_column: str, *order: Column) -> DataFrame:
    """New rows numbered on from the highest id of the target, in the given order.

    Numbers run on across value ranges of the order column instead of one sorted task;
    the order column is a whole number and unique.
    """
    from larkspur.operators.ordered import running_sums

    (key,) = order
    counted = rows.withColumns({"_k": key, "_one": F.lit(1).cast("bigint")})
    placed = running_sums(counted, [], "_k", ["_one"])
    start = target.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint").alias("m")).first()["m"]
    return placed.select((F.col("_one_before") + 1 + start).cast("bigint").alias(id_column), *rows.columns)


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """The table after an update; rows for which the condition is not true stay as they are."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({x: F.when(hit, v).otherwise(F.col(x)) for x, v in values.items()})


def delete_cascade(
    parent: DataFrame, key: str, doomed: DataFrame, children: Mapping[str, tuple[DataFrame, str]]
) -> dict[str, DataFrame]:
    """Parent and child tables without the rows of the doomed keys (one column named ``key``)."""
    left = {"parent": parent.join(doomed, key, "left_anti")}
    for name, (child, reference) in children.items():
        gone = doomed.select(F.col(key).alias(reference))
        left[name] = child.join(gone, reference, "left_anti")
    return left


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The target with matching rows replaced by the changes and the others added.

    Of several changes for one key the first by the given order counts, or by their other columns.
    """
    changes = one_per_key(changes, keys, *order)
    kept = target.join(changes.select(*keys), _same(target, changes, keys), "left_anti")
    return kept.unionByName(changes)


def orphans(child: DataFrame, reference: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose reference points at no parent row; NULL references are allowed."""
    keys = parent.select(F.col(key).alias("_key"))
    return child.where(F.col(reference).isNotNull()).join(keys, F.col(reference) == F.col("_key"), "left_anti")


def insert_all_or_nothing(
    parents: DataFrame, bridge: DataFrame, checks: Sequence[tuple[str, DataFrame, str]]
) -> tuple[DataFrame, DataFrame]:
    """Parent and bridge rows of the units of work whose references are all sound.

    Both frames carry a ``unit`` column. ``checks`` lists (bridge column, parent table,
    key). A unit with one bad reference is dropped as a whole, from both results.
    """
    bad = [orphans(bridge, reference, table, key).select("unit") for reference, table, key in checks]
    failed = reduce(DataFrame.unionByName, bad).distinct()
    return parents.join(failed, "unit", "left_anti"), bridge.join(failed, "unit", "left_anti")


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
