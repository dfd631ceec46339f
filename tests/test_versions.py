"""Stored tables that change together: commits, crashes, parts, old versions."""

import pytest
from pyspark.sql import functions as F

from larkspur.operators import versions as v
from larkspur.session import new_folder
from larkspur.streaming import events as ev
from larkspur.streaming import star
from tests.test_streaming import RECORD, click, record

TABLES = {"parts": "id int, name string", "links": "part_id int, vendor string", "sales": "id int, day string, price double"}


@pytest.fixture
def root(spark):
    folder = new_folder(spark, "store")
    v.create(spark, folder, TABLES, {"sales": "day"})
    change = v.Change(spark, folder)
    change.append("parts", spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], TABLES["parts"]))
    change.append("links", spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], TABLES["links"]))
    change.append("sales", spark.createDataFrame([(i, f"2024-01-0{1 + i % 3}", float(i)) for i in range(9)], TABLES["sales"]))
    change.commit()
    return folder


def rows_of(spark, root, name, **options):
    return sorted((tuple(r) for r in v.read(spark, root, name, **options).collect()), key=repr)


def files_of(spark, root, name):
    """File names by part."""
    out = {}
    for part in v.current(spark, root).folders[name]:
        out[part] = {r[0] for r in v.read(spark, root, name, [part]).select("_metadata.file_path").distinct().collect()}
    return out


def test_nothing_shows_before_the_commit_and_all_after(spark, root):
    before = {name: rows_of(spark, root, name) for name in TABLES}
    change = v.Change(spark, root)
    assert change.append("parts", spark.createDataFrame([(4, "d")], TABLES["parts"])) == 1
    assert change.delete("parts", "id", spark.createDataFrame([(1,)], "id int"), {"links": "part_id"}) == {"parts": 1, "links": 2}
    assert {name: rows_of(spark, root, name) for name in TABLES} == before
    change.commit()
    assert rows_of(spark, root, "parts") == [(2, "b"), (3, "c"), (4, "d")]
    assert rows_of(spark, root, "links") == [(2, "x")]
    # an earlier version stays readable
    assert rows_of(spark, root, "parts", version=v.current(spark, root, 1)) == before["parts"]


def test_a_failure_in_between_leaves_the_old_state(spark, root):
    change = v.Change(spark, root)
    change.replace("parts", spark.createDataFrame([], TABLES["parts"]))
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("int").alias("part_id"), F.lit("z").alias("vendor"))
    with pytest.raises(Exception, match="broken"):
        change.append("links", broken)
    assert len(rows_of(spark, root, "parts")) == 3 and len(rows_of(spark, root, "links")) == 3


def test_insert_update_and_their_counts(spark, root):
    change = v.Change(spark, root)
    assert change.insert("parts", spark.createDataFrame([("n", 5), ("m", 4)], "name string, place int"), "id", F.col("place")) == (2, 5)
    assert change.update("parts", F.col("name") == "a", {"name": F.lit("A")}) == 1
    assert change.update("parts", F.col("name") == "none", {"name": F.lit("A")}) == 0
    assert change.update("sales", F.col("price") > 6.5, {"price": F.lit(0.0)}) == 2
    change.commit()
    assert rows_of(spark, root, "parts") == [(1, "A"), (2, "b"), (3, "c"), (4, "m"), (5, "n")]
    assert sum(r[2] for r in rows_of(spark, root, "sales")) == 21


def test_only_parts_with_changes_are_written_again(spark, root):
    before = files_of(spark, root, "sales")
    change = v.Change(spark, root)
    changes = spark.createDataFrame([(1, "2024-01-02", 10.0), (1, "2024-01-02", 5.0), (50, "2024-02-01", 1.0)], TABLES["sales"])
    assert sorted(change.merge("sales", changes, ["id", "day"], F.col("price"))) == ["2024-01-02", "2024-02-01"]
    assert change.merge("sales", changes.limit(0), ["id", "day"]) == []
    change.commit()
    after = files_of(spark, root, "sales")
    assert {p for p in before if before[p] != after[p]} == {"2024-01-02"} and set(after) - set(before) == {"2024-02-01"}
    assert rows_of(spark, root, "sales", parts=["2024-01-02"]) == [(1, "2024-01-02", 5.0), (4, "2024-01-02", 4.0), (7, "2024-01-02", 7.0)]
    assert len(rows_of(spark, root, "sales")) == 10


def test_a_changed_column_set(spark, root):
    """Old parts are read with the new columns: absent ones are NULL, and no file of them is touched."""
    before = files_of(spark, root, "sales")
    change = v.Change(spark, root)
    change.declare("sales", "id int, day string, price double, shop string", "day")
    change.merge("sales", spark.createDataFrame([(9, "2024-01-01", 9.0, "s")], "id int, day string, price double, shop string"), ["id"])
    change.commit()
    assert [r for r in rows_of(spark, root, "sales") if r[3]] == [(9, "2024-01-01", 9.0, "s")]
    after = files_of(spark, root, "sales")
    assert {p for p in before if before[p] != after[p]} == {"2024-01-01"}


def test_parts_may_hold_any_value(spark):
    folder = new_folder(spark, "store")
    v.create(spark, folder, {"t": "k string, n int"}, {"t": "k"})
    values = ["a/b", "a=b", "", " ", "%2F", "é", "null", None, "__HIVE_DEFAULT_PARTITION__", "."]
    change = v.Change(spark, folder)
    change.append("t", spark.createDataFrame([(x, i) for i, x in enumerate(values)], "k string, n int"))
    change.commit()
    assert {r["n"]: r["k"] for r in v.read(spark, folder, "t").collect()} == dict(enumerate(values))
    assert [r["n"] for r in v.read(spark, folder, "t", ["a/b"]).collect()] == [0]
    assert v.read(spark, folder, "t", ["absent"]).collect() == []
    again = v.Change(spark, folder)
    assert again.append("t", spark.createDataFrame([], "k string, n int")) == 0


def test_compact_and_expire(spark, root):
    for i in range(3):
        change = v.Change(spark, root)
        change.append("sales", spark.createDataFrame([(100 + i, "2024-01-01", 1.0)], TABLES["sales"]))
        change.commit()
    change = v.Change(spark, root)
    assert change.compact("sales", 3) == ["2024-01-01"] and change.compact("sales", 3) == []
    change.commit()
    rows = rows_of(spark, root, "sales")
    assert len(rows) == 12 and [len(f) for f in v.current(spark, root).folders["sales"].values()] == [1, 1, 1]
    assert v.expire(spark, root, 1) == 4  # the day's four folders before they became one
    assert rows_of(spark, root, "sales") == rows
    assert v.create(spark, root, TABLES).number == 5  # a store that exists is left alone


def star_rows(spark, root):
    return {name: sorted((tuple(r) for r in star.star_table(spark, root, name).collect()), key=repr) for name in star.TABLES}


def clicks(spark, *fields):
    return spark.createDataFrame([record(i, click(**f)) for i, f in enumerate(fields)], RECORD)


def test_a_crash_between_tables_recovers(spark, monkeypatch):
    batch = clicks(spark, {"id": "e1", "product_id": "7"}, {"id": "e2", "product_id": "8", "ip": "2.2.2.2"})
    root, whole = new_folder(spark, "star"), new_folder(spark, "star")
    star.create_star(spark, root)
    star.create_star(spark, whole)
    empty = star_rows(spark, root)
    load = star.batch_loader(root, ev.enrich, source="s")
    append = v.Change.append

    def crash(change, name, rows):
        if name == "fact_sales":
            raise RuntimeError("lost")
        return append(change, name, rows)

    monkeypatch.setattr(v.Change, "append", crash)
    with pytest.raises(RuntimeError, match="lost"):
        load(batch, 0)
    assert star_rows(spark, root) == empty  # three tables were written, none shows
    monkeypatch.setattr(v.Change, "append", append)
    load(batch, 0)
    load(batch, 0)  # the stream did not know that its batch was committed
    star.batch_loader(whole, ev.enrich)(batch, 0)
    assert star_rows(spark, root) == star_rows(spark, whole) and len(star_rows(spark, root)["fact_sales"]) == 2
    assert v.current(spark, root).number == 1


DAY = 86_400


def test_a_batch_reads_its_own_days_only(spark):
    root = new_folder(spark, "star")
    star.create_star(spark, root)
    start = 1704067207  # 2024-01-01
    star.load_star(ev.enrich(clicks(spark, *[{"id": f"e{d}", "product_id": "7", "time_stamp": start + d * DAY} for d in range(10)])), root)
    batch = ev.enrich(clicks(spark, {"id": "e4", "product_id": "7", "time_stamp": start + 4 * DAY}, {"id": "new", "time_stamp": start + 5 * DAY}))
    change = v.Change(spark, root)
    stored = star.stored_rows(change, "fact_sales", batch, 1)
    read = {f.rsplit("/_part=x", 1)[1].split("/")[0] for f in stored.inputFiles()}
    assert {bytes.fromhex(p).decode() for p in read} == {f"2024-01-0{d}" for d in (4, 5, 6, 7)}
    assert star.load_star(batch, root, days_back=1)["fact_sales"] == 1
    assert star.load_star(batch, root, days_back=1)["fact_sales"] == 0
    assert star_rows(spark, root)["dim_product"] == [("7", None, None, None)]
    # a sale of a far day comes again: only a load that looks through all days knows it
    far = ev.enrich(clicks(spark, {"id": "e0", "product_id": "7", "time_stamp": start + 9 * DAY}))
    assert star.load_star(far, root)["fact_sales"] == 0


def test_days_with_many_folders_become_one(spark):
    root = new_folder(spark, "star")
    star.create_star(spark, root)
    for i in range(4):
        star.load_star(ev.enrich(clicks(spark, {"id": f"e{i}", "product_id": str(i)})), root, source="s", batch=i, folders=2)
    assert len(star_rows(spark, root)["fact_sales"]) == 4
    assert all(len(f) <= 2 for parts in v.current(spark, root).folders.values() for f in parts.values())
