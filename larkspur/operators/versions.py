"""Several stored tables changed as one.

A store is a folder. Rows are written to new folders below it, and a version names the folders that make up every
table, part by part. A version is one small file that appears in one step, so a reader sees all changes of a commit or
none, a crash before it leaves the old state, and tables keep their columns' order and types by the version.

A part holds the rows with one value of a column (a day, a bucket of keys): only parts that a change
touches are read and written again, the folders of the others are named by the next version as they are.
A store has one writer at a time. What goes to the driver is the list of folders: parts, times the few
folders of a part until it is written as one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators.mutation import insert_with_ids, update_where, upsert
from larkspur.sources.literal import literal_rows

_ROWS = "kind string, name string, part string, folder string, rows bigint, note string"
WHOLE = ""  # the only part of a table without parts


class Folder(NamedTuple):
    path: str
    rows: int


class Version(NamedTuple):
    """The state of a store: folders by table and part, schema and part column by table, last batch by source."""

    number: int
    folders: dict[str, dict[str, list[Folder]]]
    schemas: dict[str, T.StructType]
    part_columns: dict[str, str | None]
    applied: dict[str, int]

    def rows(self, name: str) -> int:
        return sum(f.rows for some in self.folders.get(name, {}).values() for f in some)


_NEW = Version(-1, {}, {}, {}, {})


def current(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The last version, or the one with a number."""
    kept = spark.read.schema(f"{_ROWS}, version bigint").option("basePath", f"{root}/versions").parquet(f"{root}/versions/version=*")
    if number is None:
        number = kept.agg(F.max("version")).first()[0]
    out = Version(number, {}, {}, {}, {})
    for r in kept.where(F.col("version") == number).collect():
        if r["kind"] == "table":
            told = json.loads(r["note"])
            out.schemas[r["name"]] = T.StructType.fromJson(told["schema"])
            out.part_columns[r["name"]] = told["part"]
            out.folders.setdefault(r["name"], {})
        elif r["kind"] == "folder":
            out.folders.setdefault(r["name"], {}).setdefault(r["part"], []).append(Folder(r["folder"], r["rows"]))
        else:
            out.applied[r["name"]] = r["rows"]
    return out


def create(spark: SparkSession, root: str, tables: Mapping[str, str | T.StructType], parts: Mapping[str, str] | None = None) -> Version:
    """A store of empty tables; one that exists is left alone. ``parts`` names the column by which a table is cut."""
    try:
        return current(spark, root)
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
    change = Change(spark, root, _NEW)
    for name, schema in tables.items():
        change.declare(name, schema, (parts or {}).get(name))
    return change.commit()


def _frame(spark: SparkSession, schema: T.StructType, folders: Iterable[Folder]) -> DataFrame:
    paths = [f.path for f in folders if f.rows]
    return spark.read.schema(schema).parquet(*paths) if paths else literal_rows(spark, [], schema)


def read(spark: SparkSession, root: str, name: str, parts: Iterable[str] | None = None, version: Version | None = None) -> DataFrame:
    """A table as of a version (the last); of given parts only these folders are listed and read."""
    version = version or current(spark, root)
    of = version.folders[name]
    wanted = of if parts is None else [p for p in dict.fromkeys(parts) if p in of]
    return _frame(spark, version.schemas[name], (f for p in wanted for f in of[p]))


def part_text(column: Column) -> Column:
    """The name of the part that a value belongs to."""
    return F.coalesce(column.cast("string"), F.lit("null"))


class Change:
    """What is about to become the next version. Nothing of it shows before ``commit``; without one it never happened."""

    def __init__(self, spark: SparkSession, root: str, base: Version | None = None):
        self.spark, self.root = spark, root
        self.base = base or current(spark, root)
        self.folders = {name: {p: list(f) for p, f in parts.items()} for name, parts in self.base.folders.items()}
        self.schemas, self.part_columns = dict(self.base.schemas), dict(self.base.part_columns)
        self.applied = dict(self.base.applied)

    def declare(self, name: str, schema: str | T.StructType, part: str | None = None) -> None:
        """A table with these columns: a new one is empty; one with other columns is read with them, absent ones as NULL."""
        self.schemas[name] = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
        self.part_columns[name] = part
        self.folders.setdefault(name, {})

    def table(self, name: str, parts: Iterable[str] | None = None) -> DataFrame:
        """The table as it is about to be."""
        of = self.folders[name]
        wanted = of if parts is None else [p for p in dict.fromkeys(parts) if p in of]
        return _frame(self.spark, self.schemas[name], (f for p in wanted for f in of[p]))

    def parts_of(self, name: str, rows: DataFrame) -> list[str]:
        """The parts that rows belong to: as many as there are parts, not rows."""
        column = self.part_columns[name]
        if column is None:
            return [WHOLE]
        return [r[0] for r in rows.select(part_text(F.col(column))).distinct().collect()]

    def _written(self, name: str, *slices: DataFrame) -> dict[str, Folder]:
        """Write rows to a new folder, slice after slice; a folder and its row count for every part."""
        schema, column = self.schemas[name], self.part_columns[name]
        path = f"{self.root}/data/{name}/{uuid.uuid4().hex}"
        typed = [rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]) for rows in slices]
        if column is None:
            count = 0
            for rows in typed:
                seen = Observation()
                rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
                count += seen.get["n"]
            return {WHOLE: Folder(path, count)}
        # names of folders in hex: values may hold any character
        part = F.concat(F.lit("x"), F.hex(part_text(F.col(column))))
        for rows in typed:
            rows.withColumn("_part", part).write.mode("append").partitionBy("_part").parquet(path)
        try:
            counts = self.spark.read.schema("_part string").parquet(path).groupBy("_part").count().collect()
        except Exception as nothing:
            if "UNABLE_TO_INFER" not in str(nothing) and "PATH_NOT_FOUND" not in str(nothing):
                raise
            counts = []
        return {bytes.fromhex(r["_part"][1:]).decode(): Folder(f"{path}/_part={r['_part']}", r["count"]) for r in counts}

    def append(self, name: str, *slices: DataFrame) -> int:
        """Add rows, which may come in slices that are written one after the other; returns how many."""
        written = self._written(name, *slices)
        for part, folder in written.items():
            if folder.rows:
                self.folders[name].setdefault(part, []).append(folder)
        return sum(f.rows for f in written.values())

    def replace(self, name: str, rows: DataFrame, parts: Iterable[str] | None = None) -> int:
        """Make the table (or some parts of it) hold exactly these rows; returns how many.

        The rows may come from the table itself, for its folders stay as they are. Rows of other parts than the
        given ones are added to those.
        """
        written = self._written(name, rows)
        for part in list(self.folders[name]) if parts is None else parts:
            self.folders[name].pop(part, None)
        for part, folder in written.items():
            if folder.rows:
                self.folders[name].setdefault(part, []).append(folder)
        return sum(f.rows for f in written.values())

    def compact(self, name: str, most: int = 8) -> list[str]:
        """Write the parts with more folders than ``most`` as one folder each; returns which."""
        many = [p for p, f in self.folders[name].items() if len(f) > most]
        if many:
            self.replace(name, self.table(name, many), many)
        return many

    def insert(self, name: str, rows: DataFrame, id_column: str, *order: Column) -> tuple[int, int]:
        """Add rows numbered on from the highest id; returns how many, and the last id."""
        added = self.append(name, insert_with_ids(self.table(name), rows, id_column, *order))
        return added, self.table(name).agg(F.max(id_column)).first()[0]

    def update(self, name: str, condition: Column, values: Mapping[str, Column]) -> int:
        """Change the rows for which the condition is true; returns how many. Only their parts are written again."""
        hits = self.table(name).where(condition)
        parts = self.parts_of(name, hits)
        if not parts:
            return 0
        seen = Observation()
        before = self.table(name, parts).observe(seen, F.count_if(condition).alias("n"))
        self.replace(name, update_where(before, condition, values), parts)
        return seen.get["n"]

    def delete(self, name: str, key: str, doomed: DataFrame, children: Mapping[str, str] | None = None) -> dict[str, int]:
        """Take out the rows with a doomed key (one column named ``key``), and the child rows that refer to them; returns how many of each table.

        Only parts with such rows are written again.
        """
        removed = {}
        for table, column in {name: key, **(children or {})}.items():
            gone = doomed.select(F.col(key).alias(column))
            parts = self.parts_of(table, self.table(table).join(gone, column, "left_semi"))
            before = sum(f.rows for p in parts for f in self.folders[table].get(p, []))
            kept = self.table(table, parts).join(gone, column, "left_anti")
            removed[table] = before - self.replace(table, kept, parts) if parts else 0
        return removed

    def merge(self, name: str, changes: DataFrame, keys: Sequence[str], *order: Column) -> list[str]:
        """Upsert by key: matching rows are replaced, the others added; returns the parts that were written again.

        The key decides the part (it is in the key, or derived from it), so a stored row lies in the part of its change.
        Of several changes for one key the first by the given order counts.
        """
        parts = self.parts_of(name, changes)
        if parts:
            self.replace(name, upsert(self.table(name, parts), changes.select(*self.schemas[name].names), keys, *order), parts)
        return parts

    def apply_once(self, source: str, batch: int) -> bool:
        """Whether a batch of a source is new; if so the commit will record it. Batches of a source come in order."""
        if self.applied.get(source, -1) >= batch:
            return False
        self.applied[source] = batch
        return True

    def commit(self) -> Version:
        """The next version: one row per folder, in one file, which is there as a whole or not at all."""
        rows: list[list] = []
        for name, schema in self.schemas.items():
            told = json.dumps({"schema": schema.jsonValue(), "part": self.part_columns[name]})
            rows.append(["table", name, None, None, None, told])
            rows += [["folder", name, p, f.path, f.rows, None] for p, some in self.folders[name].items() for f in some]
        rows += [["applied", source, None, None, batch, None] for source, batch in self.applied.items()]
        number = self.base.number + 1
        literal_rows(self.spark, rows, _ROWS).coalesce(1).write.mode("error").parquet(f"{self.root}/versions/version={number}")
        return Version(number, self.folders, self.schemas, self.part_columns, self.applied)


def expire(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove all but the last versions, and the folders that only the removed ones name; returns how many folders."""
    last = current(spark, root).number
    kept = spark.read.schema(f"{_ROWS}, version bigint").option("basePath", f"{root}/versions").parquet(f"{root}/versions/version=*")
    old = F.col("version") <= last - keep
    named = kept.where("kind = 'folder'").groupBy("folder").agg(F.min(old).alias("gone")).where("gone")
    folders = [r["folder"] for r in named.collect()]
    numbers = [r[0] for r in kept.where(old).select("version").distinct().collect()]
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    # versions first: a reader never finds one whose folders are gone
    for path in [f"{root}/versions/version={n}" for n in numbers] + folders:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    return len(folders)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """A part column for tables without a natural one: a bucket of the key."""
    mixed = reduce(lambda a, b: F.concat(a, F.lit("\x00"), b), [F.coalesce(F.col(k).cast("string"), F.lit("\x01")) for k in keys])
    return F.crc32(mixed.cast("binary")) % buckets
