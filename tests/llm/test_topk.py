import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import topk


def brute(rows, k, factor=256):
    good = [(i, [math.floor(factor * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for i in sorted({i for i, _ in good if i % 5 == 0}):
        q = min(v for j, v in good if j == i)
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q))
        out |= {(i, r + 1): (j, -s) for r, (s, j) in enumerate(scored[:k])}
    return out


def found(spark, rows, k, **settings):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int").repartition(3)
    cfg = topk.Settings(**settings)
    return {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(df, F.col("vec_id") % 5 == 0, k, settings=cfg).collect()}


@pytest.mark.parametrize("settings", [{}, {"block_rows": 16, "query_rows": 5, "pivots": 4, "leaf": 2, "children": 3}])
def test_against_brute_force(spark, settings):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(5, 6))
    rows = [(i, [float(np.float32(x)) for x in (centers[i % 5] + 0.3 * rng.normal(size=6))]) for i in range(150)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # one vector of many rows: ties
    assert found(spark, [(i, v, 7) for i, v in rows], 3, **settings) == brute(rows, 3)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, []), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [1.0, float("inf")]), (None, [1.0, 1.0]),
        (6, [1.0, 2.0]), (6, [1.0, 2.0]), (7, [0.5, -0.5]), (10, [0.0, 0.0]), (10, [1.0, 0.0]), (15, [1.0, 1.0, 1.0]), (20, [1e30, -1e30]),
    ]
    limit = math.isqrt(2**62 // 2) / 256
    want = brute([(i, v if i != 20 else [limit, -limit]) for i, v in rows], 4)
    got = found(spark, [(i, v, None) for i, v in rows], 4)
    assert {k: v for k, v in got.items() if 20 not in (k[0], v[0])} == {k: v for k, v in want.items() if 20 not in (k[0], v[0])}
    assert not any(q == 15 for q, _ in got) and set(got) == set(want)
    assert found(spark, [(0, [1.0], None)], 4) == {}
    assert found(spark, [], 4) == {}


def test_a_tree_covers_its_points():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(300, 5)), np.ones((50, 5))])
    cfg = topk.Settings(leaf=4, children=3)
    root, order = topk.cover_tree(points, cfg)

    def check(node):
        own = points[order[node.begin : node.end]]
        assert np.sqrt(((own - node.center) ** 2).sum(axis=1)).max() <= node.radius + 1e-9
        if node.children:
            assert [c.begin for c in node.children] == [node.begin, *[c.end for c in node.children[:-1]]] and node.children[-1].end == node.end
            for c in node.children:
                check(c)

    check(root)
    assert sorted(order) == list(range(350))
