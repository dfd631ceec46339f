"""Exact top-k by inner product: a dual-tree search over cover trees.

Vectors are dealt to blocks of bounded size around pivots picked from a bounded sample; every
row is in one block. Queries are dealt in the same way. First each query block visits the
block nearest to it, which gives every query a score that its kth best must reach. Then it visits
those blocks whose ball can still hold a better one. Inside a visit, cover trees of both
blocks go down together: a pair of nodes is left out if no point in the one ball can score above
the worst kth score in the other. Nothing but such pairs is left out, so results are exact.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.session import cut_lineage


class Settings(NamedTuple):
    """Rows of a block on average, pivots (picked among ``sample`` rows), points of a leaf and children of a node."""

    block_rows: int = 4096
    query_rows: int = 512
    pivots: int = 64
    sample: int = 4096
    leaf: int = 48
    children: int = 12


class Node(NamedTuple):
    """A ball around a point of the tree: its radius covers the points ``begin`` to ``end`` - 1."""

    center: np.ndarray
    norm: float
    radius: float
    begin: int
    end: int
    children: list


def cover_tree(points: np.ndarray, cfg: Settings) -> tuple[Node, np.ndarray]:
    """A cover tree and the order of the points in it.

    The children of a node are centred on points of it that are chosen farthest first, beginning with
    its own centre: they lie at least as far apart as the radius within which they cover its points.
    """
    order = np.arange(len(points))

    def grow(begin: int, end: int, center: np.ndarray) -> Node:
        own = points[order[begin:end]]
        far = np.sqrt(((own - center) ** 2).sum(axis=1))
        radius = float(far.max())
        children: list[Node] = []
        if end - begin > cfg.leaf and radius > 0:
            nearest, owner, centers = far, np.zeros(end - begin, dtype=np.int64), [center]
            while len(centers) < cfg.children and nearest.max() > 0:
                centers.append(own[int(nearest.argmax())])
                distance = np.sqrt(((own - centers[-1]) ** 2).sum(axis=1))
                closer = distance < nearest
                nearest, owner = np.where(closer, distance, nearest), np.where(closer, len(centers) - 1, owner)
            dealt = np.argsort(owner, kind="stable")
            order[begin:end] = order[begin:end][dealt]
            bounds = begin + np.searchsorted(owner[dealt], np.arange(len(centers) + 1))
            children = [grow(int(a), int(b), c) for a, b, c in zip(bounds[:-1], bounds[1:], centers) if b > a]
        return Node(center, float(np.sqrt((center**2).sum())), radius, begin, end, children)

    root = grow(0, len(points), points[0])
    return root, order


def best_score(q: Node, r: Node) -> float:
    """No point of one ball scores more with one of the other."""
    exact = float(q.center @ r.center) + q.norm * r.radius + r.norm * q.radius + q.radius * r.radius
    return exact + 1e-9 * (abs(exact) + (q.norm + q.radius) * (r.norm + r.radius))  # rounding


class Best:
    """The k best (score, id) of each query so far: higher scores first, then smaller ids."""

    def __init__(self, ids: np.ndarray, least: np.ndarray, k: int):
        self.ids, self.least, self.k = ids, least.copy(), k
        self.rows: list[list[tuple[int, int]]] = [[] for _ in ids]

    def offer(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        good = np.flatnonzero((scores >= self.least[query]) & (ids != self.ids[query]))
        if len(good) > 4 * self.k:
            kth = np.partition(scores[good], len(good) - self.k)[len(good) - self.k]
            good = good[scores[good] >= kth]
        if len(good):
            rows = self.rows[query] + list(zip((-scores[good]).tolist(), ids[good].tolist()))
            rows.sort()
            self.rows[query] = rows = rows[: self.k]
            if len(rows) == self.k:
                self.least[query] = max(self.least[query], -rows[-1][0])


def search(queries: np.ndarray, points: np.ndarray, ids: np.ndarray, best: Best, cfg: Settings) -> None:
    """Offer every pair of a query and a point that can matter."""
    exact = np.float64 if max(np.abs(queries).max(), np.abs(points).max(), 1) ** 2 * queries.shape[1] < 2**53 else np.int64
    q_root, q_order = cover_tree(queries.astype(np.float64), cfg)
    r_root, r_order = cover_tree(points.astype(np.float64), cfg)
    q_points, r_points, r_ids = queries[q_order].astype(exact), points[r_order].astype(exact), ids[r_order]

    def visit(q: Node, r: Node, bound: float) -> None:
        if bound < best.least[q_order[q.begin : q.end]].min():
            return
        if not q.children and not r.children:
            scores = (q_points[q.begin : q.end] @ r_points[r.begin : r.end].T).astype(np.int64)
            for i in np.flatnonzero(scores.max(axis=1) >= best.least[q_order[q.begin : q.end]]):
                best.offer(int(q_order[q.begin + i]), scores[i], r_ids[r.begin : r.end])
            return
        # the wider ball is opened; the pairs with the best prospects raise the bar for the others
        if r.children and (not q.children or r.radius >= q.radius):
            pairs = [(q, x) for x in r.children]
        else:
            pairs = [(x, r) for x in q.children]
        for bound_of, _, a, b in sorted(((best_score(a, b), i, a, b) for i, (a, b) in enumerate(pairs)), key=lambda x: (-x[0], x[1])):
            visit(a, b, bound_of)

    visit(q_root, r_root, best_score(q_root, r_root))


def whole_numbers(vector: Column, factor: float) -> Column:
    """floor(factor * x) of each component as double; null if the vector or a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("bigint"))
    return F.when(vector.isNotNull() & ~bad, whole)


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors as rows; components are held within what a long can sum exactly."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    matrix = flat.reshape(len(column), -1) if len(flat) else np.zeros((len(column), 1), dtype=np.int64)
    limit = math.isqrt(2**62 // matrix.shape[1])
    return np.clip(matrix, -limit, limit)


def _nearest(pivots: dict[int, np.ndarray]):
    @F.arrow_udf("int")
    def nearest(vectors: pa.Array) -> pa.Array:
        sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
        out = np.zeros(len(vectors), dtype=np.int32)
        for size in np.unique(sizes):
            of = np.flatnonzero(sizes == size)
            if size and int(size) in pivots:
                points, centers = _matrix(vectors.take(pa.array(of))).astype(np.float64), pivots[int(size)]
                for at in range(0, len(of), 1024):
                    block = points[at : at + 1024]
                    far = (centers**2).sum(axis=1) - 2 * block @ centers.T
                    out[of[at : at + 1024]] = far.argmin(axis=1)
        return pa.array(out)

    return nearest


def _pivots(vectors: DataFrame, cfg: Settings) -> dict[int, np.ndarray]:
    """Pivots for each number of components, chosen farthest first from a sample of bounded size."""
    sample = vectors.orderBy(F.xxhash64("id", "vector")).limit(cfg.sample).select("vector").toArrow()["vector"].to_pylist()
    out = {}
    for size in {len(v) for v in sample if v}:
        points = _matrix(pa.array([v for v in sample if len(v) == size], type=pa.list_(pa.int64()))).astype(np.float64)
        chosen = [0]
        far = ((points - points[0]) ** 2).sum(axis=1)
        while len(chosen) < cfg.pivots and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
        out[size] = points[chosen]
    return out


def _dealt(vectors: DataFrame, pivots: dict[int, np.ndarray], rows: int, label: str) -> DataFrame:
    """The vectors with a block number: by size and nearest pivot, and by a hash where a pivot has many."""
    spark = vectors.sparkSession
    near = vectors.withColumn("cell", F.struct(F.size("vector").alias("size"), _nearest(pivots)(F.col("vector")).alias("pivot")))
    near = cut_lineage(spark, near, label)
    # one row for each pivot of the bounded set, and each number of components
    cells = near.groupBy("cell").count().withColumn("parts", F.ceil(F.col("count") / rows).cast("int"))
    part = F.pmod(F.xxhash64("id", "vector"), F.col("parts"))
    return near.join(F.broadcast(cells.select("cell", "parts")), "cell").select(
        "id", "vector", F.col("cell.size").alias("size"), F.concat_ws(".", "cell.size", "cell.pivot", part).alias("block")
    )


def _ball_of(points: np.ndarray) -> tuple[np.ndarray, float]:
    center = points.astype(np.float64).mean(axis=0)
    return center, float(np.sqrt(((points - center) ** 2).sum(axis=1)).max())


def _blocks(dealt: DataFrame) -> DataFrame:
    """The centre and radius of the ball around each block."""

    def ball(table: pa.Table) -> pa.Table:
        center, radius = _ball_of(_matrix(table["vector"]))
        return pa.table({"block": [table["block"][0].as_py()], "size": pa.array([len(center)], pa.int32()), "center": [center.tolist()], "radius": [radius]})

    return dealt.groupBy("block").applyInArrow(ball, "block string, size int, center array<double>, radius double")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _visits(k: int, cfg: Settings):
    def visit(queries: pa.Table, points: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if queries.num_rows and points.num_rows:
            best = Best(queries["id"].to_numpy(), queries["least"].to_numpy(), k)
            search(_matrix(queries["vector"]), _matrix(points["vector"]), points["id"].to_numpy(), best, cfg)
            for query, rows in zip(best.ids.tolist(), best.rows):
                for score, vec in rows:
                    out["query_id"].append(query)
                    out["vec_id"].append(vec)
                    out["score"].append(-score)
        return pa.table(out, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]))

    return visit


def top_k(
    vectors: DataFrame, queries: Column, k: int, factor: float = 256.0, id_column: str = "vec_id", vector: str = "embedding",
    settings: Settings = Settings(),
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows with the highest integer inner product for each query.

    Components are turned into floor(``factor`` * x). ``queries`` tells which rows are queries; the candidates of
    one are the rows with another id and as many components. Ties go to the smaller id. Rows with a null id, and
    vectors that are null or empty or hold a null or non-finite component, take no part. A row that occurs
    twice is two candidates, but a query id has one result: that of one of its rows with the smallest vector. Components
    past the square root of 2 ** 62 by their number are cut to that, so that a sum always fits a long.
    """
    spark = vectors.sparkSession
    cfg = settings
    clean = vectors.select(
        F.col(id_column).cast("bigint").alias("id"), whole_numbers(F.col(vector), factor).alias("vector"), queries.alias("is_query")
    ).where("id is not null and vector is not null and size(vector) > 0")
    clean = cut_lineage(spark, clean, "vectors")
    pivots = _pivots(clean.select("id", "vector"), cfg)
    points = _dealt(clean.select("id", "vector"), pivots, cfg.block_rows, "points")
    asked = clean.where("is_query").groupBy("id").agg(F.min("vector").alias("vector"))
    asking = _dealt(asked, pivots, cfg.query_rows, "queries").withColumnRenamed("block", "q_block")

    balls = cut_lineage(spark, _blocks(points), "balls")
    q_balls = _blocks(asking.withColumnRenamed("q_block", "block")).select(
        F.col("block").alias("q_block"), "size", F.col("center").alias("q_center"), F.col("radius").alias("q_radius")
    )
    # blocks against blocks, not rows: some thousandth part of both tables
    prospect = (
        _dot(F.col("q_center"), F.col("center"))
        + F.sqrt(_dot(F.col("q_center"), F.col("q_center"))) * F.col("radius")
        + F.sqrt(_dot(F.col("center"), F.col("center"))) * F.col("q_radius") + F.col("radius") * F.col("q_radius")
    )
    pairs = cut_lineage(spark, q_balls.join(balls, "size").select("q_block", "block", prospect.alias("prospect")), "pairs")
    rank = F.row_number().over(Window.partitionBy("q_block").orderBy(F.desc("prospect"), "block"))
    ranked = pairs.withColumn("turn", rank)

    def visited(which: DataFrame, asking: DataFrame) -> DataFrame:
        visits = which.select("q_block", "block")
        left = asking.join(visits, "q_block")
        right = points.join(visits, "block")
        return left.groupBy("q_block", "block").cogroup(right.groupBy("q_block", "block")).applyInArrow(
            _visits(k, cfg), "query_id bigint, vec_id bigint, score bigint"
        )

    lowest = F.lit(-(2**63) + 1).cast("bigint")
    first = cut_lineage(spark, visited(ranked.where("turn = 1"), asking.withColumn("least", lowest)), "first")
    reached = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    bar = F.when(F.col("n") >= k, F.col("kth")).otherwise(lowest)
    barred = asking.join(reached, F.col("id") == F.col("query_id"), "left").select(
        "id", "vector", "q_block", F.coalesce(bar, lowest).alias("least")
    )
    barred = cut_lineage(spark, barred, "barred")
    worst = barred.groupBy("q_block").agg(F.min("least").alias("worst"))
    slack = 1e-9 * (1 + F.abs("prospect"))
    hopeful = ranked.where("turn > 1").join(worst, "q_block").where(F.col("prospect") + slack >= F.col("worst"))
    both = first.unionByName(visited(hopeful, barred))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        both.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
