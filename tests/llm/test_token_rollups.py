import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from larkspur.llm import token_rollups as tr
from tests.llm.frames import no_docs, odd_docs, odd_rows

#: names that the operator uses itself
SCHEMA = "source string, lang string, tokens bigint, old bigint, version string, documents bigint, run string, batch string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "v", 77, "r", "b") for r in rows], SCHEMA)


def totals(spark, store):
    return {(r["source"], r["lang"], r["version"]): (r["documents"], r["tokens"]) for r in tr.totals(spark, store).collect()}


def test_signed_changes_against_counters(spark):
    dice, store = random.Random(7), tr.create_store(spark)
    want = {}
    for batch in range(6):
        rows = [(dice.choice(["web", "book", "", None]), dice.choice(["en", "fr", None]), dice.choice([0, 3, 50, None]), dice.choice([1, 9])) for _ in range(40)]
        df = frame(spark, rows * 2)  # repeated rows count each
        kind = ["insert", "delete", "revise"][batch % 3]
        changes = {
            "insert": tr.inserted(df, "a", F.col("tokens")), "delete": tr.deleted(df, "a", F.col("tokens")),
            "revise": tr.revised(df, "b", F.col("old"), F.col("tokens")),
        }[kind]
        assert tr.commit(spark, store, f"batch {batch}", changes)
        for source, lang, new, old in rows * 2:
            n, t = want.get((source, lang, "b" if kind == "revise" else "a"), (0, 0))
            step = {"insert": (1, new or 0), "delete": (-1, -(new or 0)), "revise": (0, (new or 0) - old)}[kind]
            want[source, lang, "b" if kind == "revise" else "a"] = (n + step[0], t + step[1])
        assert totals(spark, store) == {k: v for k, v in want.items() if v != (0, 0)}
    # every batch is there already, whatever it now holds
    assert not any(tr.commit(spark, store, f"batch {b}", tr.inserted(df, "a", F.col("tokens"))) for b in range(6))
    assert totals(spark, store) == {k: v for k, v in want.items() if v != (0, 0)}


def test_a_batch_that_broke_off_does_not_count(spark):
    store, df = tr.create_store(spark), frame(spark, [("web", "en", 5, 1)])
    tr.commit(spark, store, "one", tr.inserted(df, "a", F.col("tokens")))

    def broken(x):
        raise ValueError("lost")

    changes = tr.inserted(df, "a", F.col("tokens"))
    with pytest.raises(Exception, match="lost"):
        tr.commit(spark, store, "two", changes.withColumn("tokens", F.udf(broken, "bigint")("tokens")))
    # the sums of a writer that stopped before its row in the log
    left = changes.groupBy(*tr.KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    left.withColumn("run", F.lit("stopped")).write.mode("append").parquet(f"{store}/sums")
    assert totals(spark, store) == {("web", "en", "a"): (1, 5)}
    assert tr.commit(spark, store, "two", changes)
    assert totals(spark, store) == {("web", "en", "a"): (2, 10)}


def test_two_writers_of_one_batch_count_once(spark):
    store, df = tr.create_store(spark), frame(spark, [("web", "en", 5, 1)])
    tr.commit(spark, store, "one", tr.inserted(df, "a", F.col("tokens")))
    other = tr.inserted(df, "a", F.col("tokens")).withColumn("run", F.lit("0 other"))
    other.write.mode("append").parquet(f"{store}/sums")
    spark.createDataFrame([("one", "0 other")], "batch string, run string").write.mode("append").parquet(f"{store}/log")
    assert totals(spark, store) == {("web", "en", "a"): (1, 5)}


def test_odd_rows_and_empty_tables(spark):
    store = tr.create_store(spark)
    assert tr.totals(spark, store).columns == [*tr.KEYS, "documents", "tokens"] and totals(spark, store) == {}
    assert tr.commit(spark, store, "none", tr.inserted(no_docs(spark), "a", F.col("n_chars")))
    assert not tr.commit(spark, store, "none", tr.inserted(odd_docs(spark), "a", F.col("n_chars")))
    assert totals(spark, store) == {}
    assert tr.commit(spark, store, "odd", tr.inserted(odd_docs(spark), "a", F.length("text")))
    want, tokens = Counter(), Counter()
    for _, text, lang, source, *_ in odd_rows():
        want[source, lang, "a"] += 1
        tokens[source, lang, "a"] += len(text or "")
    assert totals(spark, store) == {k: (n, tokens[k]) for k, n in want.items()}
    # taken back as a whole, nothing is left
    assert tr.commit(spark, store, "back", tr.deleted(odd_docs(spark), "a", F.length("text")))
    assert totals(spark, store) == {}
