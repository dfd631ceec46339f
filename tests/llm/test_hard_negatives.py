import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import hard_negatives as hn
from larkspur.llm.queries import QUERIES, SQL
from tests.compare import compare, duck
from tests.llm.frames import SF_DIR


def brute(rows, positives, negatives, low=30, high=90):
    """Rows as (anchor, positive, rank, negative, positive score, negative score)."""
    good = [
        (i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for anchor in sorted({i for i, _, _ in good if i % 5 == 0}):
        label, q = min((lab, v) for i, lab, v in good if i == anchor)
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i, lab) for i, lab, v in good if len(v) == len(q))
        for s, positive, _ in [x for x in scored if x[2] == label and x[1] != anchor][:positives]:
            fits = [x for x in scored if x[2] != label and low * -s <= -100 * x[0] <= high * -s][:negatives]
            out += [(anchor, positive, r + 1, n, -s, -t) for r, (t, n, _) in enumerate(fits)]
    return sorted(out)


def found(spark, rows, positives, negatives, **settings):
    df = spark.createDataFrame([(*r, 1, "b", "k") for r in rows], "vec_id bigint, embedding array<float>, label int, rank int, block string, key string")
    mined = hn.mine(df.repartition(3), F.col("vec_id") % 5 == 0, F.col("label"), positives, negatives, settings=hn.Settings(**settings))
    return sorted(tuple(r) for r in mined.collect())


def clustered(n, dims=6):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(5, dims))
    return [(i, [float(np.float32(x)) for x in centers[i % 5] + 0.5 * rng.normal(size=dims)], int(rng.integers(3))) for i in range(n)]


def test_query_against_sql(spark):
    name = "op11_hard_negatives"
    ok, message = compare(spark, duck(SF_DIR), name, QUERIES[name], SQL[name], SF_DIR)
    assert ok, message


@pytest.mark.parametrize("settings", [{}, {"block_rows": 16, "group_rows": 4, "turns": 2, "bits": 3}])
def test_against_brute_force(spark, settings):
    rows = clustered(160)
    rows += [(1000 + i, rows[3][1], i % 2) for i in range(40)]  # one vector of many rows: ties
    want = brute(rows, 2, 4)
    assert len(want) > 100
    assert found(spark, rows, 2, 4, **settings) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (1, None, 1), (2, [], 1), (3, [None, 1.0], 1), (4, [nan, 1.0], 1), (5, [1.0, inf], 1), (None, [1.0, 1.0], 1), (6, [1.0, 1.0], None),
        (7, [1.0, 1.5], 1), (7, [1.0, 1.5], 1), (8, [0.5, 0.5], 2), (8, [0.5, 0.5], 2), (10, [-1.0, 0.0], 2), (10, [1.0, 0.0], 1), (11, [0.0, 1.0], 3), (15, [1.0], 1),
        (16, [0.5], 2), (17, [0.9], 1), (20, [], 2),
    ]
    assert found(spark, rows, 3, 3) == brute(rows, 3, 3)
    assert found(spark, rows[:1], 3, 3) == [] and found(spark, [], 3, 3) == []


def test_huge_components_are_compared_exactly(spark):
    big = 2.0**22  # scores pass 2 ** 53
    rows = [(0, [big, 1.0], 1), (1, [big, 2.0], 1), (2, [big, 1.0], 1), (3, [big / 2, 3.0], 2), (4, [big / 2, 2.0], 2)]
    got = found(spark, rows, 2, 2)
    assert got == brute(rows, 2, 2) != []
    past = [(i, [x * 2.0**60 for x in v], label) for i, v, label in rows]
    assert found(spark, past, 2, 2) == []  # all scores are the greatest long


@pytest.mark.parametrize("dims, bits", [(2, 1), (2, 3), (3, 2), (4, 2)])
def test_the_curve_walks_through_neighbours(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = [k.tobytes() for k in hn.hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    walk = cells[sorted(range(len(cells)), key=lambda i: keys[i])]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_blocks_apart_are_not_read(spark):
    """Zone maps of far clusters rule each other out."""
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in (np.array([8.0, 0, 0]) if i % 2 else np.array([0, 0, 8.0])) + 0.1 * rng.normal(size=3)], i // 2 % 2) for i in range(400)]
    clean = spark.createDataFrame(rows, "id bigint, vector array<double>, label bigint").select(
        "id", "label", F.transform("vector", lambda x: F.floor(256 * x)).alias("vector"), F.lit(3).alias("size")
    )
    keyed = clean.withColumn("key", hn._curve(hn._spread_of(clean), 2)("vector", "size"))
    blocks = hn.packed(keyed, 50, "blocks")
    assert blocks.count() == 8 and blocks.agg(F.sum("rows")).first()[0] == 400
    pairs = hn._pairs(blocks, blocks, False, "pairs")
    worst = 256 * 256 * 8 * 8 // 4
    assert pairs.where(F.col("most") >= worst).count() < 0.7 * pairs.count()
