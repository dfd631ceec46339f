import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import mixing, token_rollups
from larkspur.llm.queries import MIX_EXPONENTS, QUERIES, SQL
from tests.compare import compare, duck
from tests.llm.frames import SF_DIR, no_docs, odd_docs, odd_rows, words

DIMS = ["source", "lang"]


def cells_of(spark, table):
    return spark.createDataFrame([(f"s{i}" if i else None, f"l{j}", int(n)) for (i, j), n in np.ndenumerate(table)], "source string, lang string, tokens bigint")


def test_raking_against_numpy(spark):
    table = np.array([[40.0, 10, 5], [300, 20, 0], [7, 80, 9]])
    rows, columns = np.array([0.3, 0.3, 0.4]), np.array([0.5, 0.25, 0.25])
    want = table.copy()
    for _ in range(200):
        want *= (rows * table.sum() / want.sum(axis=1))[:, None]
        want *= columns * table.sum() / want.sum(axis=0)
    targets = {
        "source": spark.createDataFrame([(f"s{i}" if i else None, float(2 * x)) for i, x in enumerate(rows)] + [("absent", 5.0)], "source string, share double"),
        "lang": spark.createDataFrame([(f"l{j}", float(x)) for j, x in enumerate(columns)], "lang string, share double"),
    }
    got = mixing.rake(cells_of(spark, table), targets, mixing.Settings(rounds=60, tolerance=1e-9)).collect()
    for r in got:
        i, j = (int(r["source"][1:]) if r["source"] else 0), int(r["lang"][1:])
        assert r["weight"] == pytest.approx(want[i, j], rel=1e-6, abs=1e-9)


def test_bounded_raking_meets_targets_without_passing_a_cell(spark):
    table = np.array([[40.0, 10, 5], [300, 20, 0], [7, 80, 9]])
    targets = {
        "source": spark.createDataFrame([(None, 0.3), ("s1", 0.3), ("s2", 0.4)], "source string, share double"),
        "lang": spark.createDataFrame([("l0", 0.5), ("l1", 0.4), ("l2", 0.1)], "lang string, share double"),
    }
    cells = cells_of(spark, table)
    raked = mixing.probabilities(mixing.rake(cells, targets, mixing.Settings(keep=1.0, rounds=200, tolerance=1e-6), bounded=True))
    rows = raked.collect()
    # the third language has 14 tokens and a tenth of the sample
    assert sum(r["weight"] for r in rows) == pytest.approx(0.98 * 140, rel=1e-3)
    assert all(0 <= r["weight"] <= r["tokens"] and r["probability"] == pytest.approx(r["weight"] / r["tokens"] if r["tokens"] else 0) for r in rows)
    told = {(r["dimension"], r["value"]): (r["share"], r["target"]) for r in mixing.marginals(raked, targets).collect()}
    assert len(told) == 6 and all(share == pytest.approx(target, rel=1e-3) for share, target in told.values())


def test_many_cells_are_raked_as_few_ones(spark, monkeypatch):
    rows = [(f"s{i % 7}" if i % 7 else None, f"l{i % 5}", 1 + i * i % 40) for i in range(35)]
    cells = spark.createDataFrame(rows, "source string, lang string, tokens bigint").repartition(3)
    targets = {d: mixing.tempered(cells, d, 0.5) for d in DIMS}
    found = []
    for limit in (100, 34):
        monkeypatch.setattr(mixing, "CELLS_TO_A_TASK", limit)
        found.append({r["source"] + r["lang"] if r["source"] else r["lang"]: r["weight"] for r in mixing.rake(cells, targets, bounded=True).collect()})
    assert len(found[0]) == 35 and found[0] == pytest.approx(found[1], rel=1e-9)


def test_a_round_on_few_cells_shuffles_nothing(spark, monkeypatch):
    cells = spark.createDataFrame([(f"s{i % 7}", f"l{i % 5}", 1 + i * i % 40) for i in range(35)], "source string, lang string, tokens bigint")
    targets = {d: mixing.tempered(cells, d, 0.5) for d in DIMS}
    plans, cut = [], mixing.cut_lineage

    def seen(session, df, label):
        plans.extend([df._jdf.queryExecution().executedPlan().toString()] if label == "raked" else [])
        return cut(session, df, label)

    monkeypatch.setattr(mixing, "cut_lineage", seen)
    mixing.rake(cells, targets, mixing.Settings(rounds=2, tolerance=0.0))
    assert len(plans) == 2 and not any("Exchange" in p or "Join" in p for p in plans)


def test_sample_follows_its_probabilities(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = QUERIES["op5_source_mixing"](spark, "/root/testdata/sf0.01").cache()
    expected = F.sum(F.col("tokens") * F.col("probability")).alias("expected")
    row = mixed.agg(F.sum("tokens").alias("all"), expected, F.sum(F.when(F.col("kept"), F.col("tokens"))).alias("kept")).first()
    assert row["kept"] / row["all"] == pytest.approx(row["expected"] / row["all"], abs=0.06)
    # expected marginals lie within a hundredth of their targets
    for d, exponent in MIX_EXPONENTS.items():
        sums = {r[d]: (r["tokens"], r["expected"]) for r in mixed.groupBy(d).agg(F.sum("tokens").alias("tokens"), expected).collect() if r["tokens"]}
        whole = sum(t**exponent for t, _ in sums.values())
        for tokens, got in sums.values():
            assert got / row["expected"] == pytest.approx(tokens**exponent / whole, rel=0.01)
    assert mixed.count() == docs.count() == 1000
    again = QUERIES["op5_source_mixing"](spark, "/root/testdata/sf0.01")
    assert not mixed.select("doc_id", "kept").exceptAll(again.select("doc_id", "kept")).count()
    plan = mixed._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_topics(spark):
    texts = {"a" * 49 + "1": "numeric", "a" * 70 + "1": "prose", "a" * 99 + "|": "marked", "x" * 58 + "\n": "listed", "x" * 120 + "\n": "prose", "": "empty"}
    df = spark.createDataFrame([(x,) for x in texts] + [(None,)], "t string")
    assert {r["t"]: r["k"] for r in df.select("t", mixing.topic_of(F.col("t")).alias("k")).collect()} == {**texts, None: "empty"}


def test_mixing_odd_rows(spark):
    docs = odd_docs(spark)
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic_of(F.col("text"))}
    rows = mixing.mix(docs, dims, settings=mixing.Settings(rounds=3)).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r["tokens"] == len(words(r["row"]["text"]))
        assert r["kept"] is False if not r["tokens"] else 0 <= r["probability"] <= 1
        assert set(r["row"].asDict()) == set(docs.columns)
    assert mixing.mix(no_docs(spark), dims).count() == 0


def test_rollup_query_against_sql(spark):
    ok, message = compare(spark, duck(SF_DIR), "op7", QUERIES["op7_token_rollups"], SQL["op7_token_rollups"], SF_DIR)
    assert ok, message


def test_batches_count_once(spark):
    docs = spark.createDataFrame([("a", "en", 3), ("a", "en", None), (None, "fr", 4)], "source string, lang string, n int")
    store = token_rollups.create_store(spark)
    assert token_rollups.commit(spark, store, "1", token_rollups.inserted(docs, "v", F.col("n")))
    assert not token_rollups.commit(spark, store, "1", token_rollups.inserted(docs, "v", F.col("n")))

    def totals():
        return {(r["source"], r["lang"], r["version"]): (r["documents"], r["tokens"]) for r in token_rollups.totals(spark, store).collect()}

    assert totals() == {("a", "en", "v"): (2, 3), (None, "fr", "v"): (1, 4)}
    part = docs.where("source = 'a'")
    assert token_rollups.commit(spark, store, "2", token_rollups.revised(part, "v", F.col("n"), F.col("n") * 2))
    assert token_rollups.commit(spark, store, "3", token_rollups.deleted(docs.where("source is null"), "v", F.col("n")))
    assert token_rollups.commit(spark, store, "4", docs.select("*").where("n > 9").transform(lambda d: token_rollups.inserted(d, "v", F.col("n"))))
    assert totals() == {("a", "en", "v"): (2, 6)}


def test_a_broken_or_doubled_commit_counts_once(spark):
    docs = spark.createDataFrame([("a", "en", 3)], "source string, lang string, n int")
    store = token_rollups.create_store(spark)
    sums = "source string, lang string, version string, documents bigint, tokens bigint, run string"
    # a writer that died before the log, and two that sent one batch at once
    for run in ("dead", "r1", "r2"):
        spark.createDataFrame([("a", "en", "v", 1, 3, run)], sums).write.mode("append").parquet(f"{store}/sums")
    spark.createDataFrame([("b", "r1"), ("b", "r2")], "batch string, run string").write.mode("append").parquet(f"{store}/log")
    assert not token_rollups.commit(spark, store, "b", token_rollups.inserted(docs, "v", F.col("n")))
    assert [tuple(r) for r in token_rollups.totals(spark, store).collect()] == [("a", "en", "v", 1, 3)]
