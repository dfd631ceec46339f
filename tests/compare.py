"""Run a named query and its SQL on the same tables and compare rows as multisets."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


FAMILY = {
    "bigint": "int64", "int": "int32", "integer": "int32", "smallint": "int16", "tinyint": "int8",
    "double": "double", "float": "float", "string": "str", "varchar": "str", "boolean": "bool",
    "date": "date", "binary": "bytes", "blob": "bytes",
}


def compare(spark, con, name, query, sql, sf_dir):
    """Return (ok, message)."""
    df = query(spark, sf_dir)
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = df.collect()
    if sql is None:
        return len(rows) > 0, f"{len(rows)} rows (no SQL)"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    expected = cur.fetchall()
    duck_types = {r[0]: r[1].lower() for r in con.execute("describe " + sql).fetchall()}
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(columns)}"
    bad = {
        c: (spark_types[c], duck_types[c])
        for c in columns
        if FAMILY.get(spark_types[c], spark_types[c]) != FAMILY.get(duck_types[c], duck_types[c])
    }
    if bad:
        return False, f"types {bad}"
    got, want = _rows(df.columns, rows), _rows(columns, expected)
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return False, f"{len(rows)} vs {len(expected)} rows; extra {extra}; missing {missing}"
    if not rows:
        return False, "empty result"
    return True, f"{len(rows)} rows"


def main(argv):
    import __spark_entry__ as entry
    from larkspur.session import build_session

    sf_dir = "/root/testdata/sf0.01"
    args = argv[1:]
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g",
                                  "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = []
    for name, query in sorted(queries.items()):
        if args and not any(name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            ok, message = compare(spark, con, name, query, sql.get(name), sf_dir)
        except Exception as error:  # report every query, then fail
            ok, message = False, f"{type(error).__name__}: {str(error)[:600]}"
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.2f}s {message}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
