"""Hard negatives: rows of another label that score nearly as high as an anchor's positives.

Candidates are laid along a Hilbert curve (per label, dimensions of high variance first) and cut into
blocks, which are written with a zone map each: the least and the greatest value of every dimension, and
of the label. Anchors are laid out in the same way, in groups. From two boxes interval arithmetic gives
a lower and an upper bound of every inner product between them, so a group reads only those blocks whose
bounds reach into one of its windows; inside, the same bounds are taken for each anchor by itself.

Both steps are such a search: the positives are the best rows with the anchor's label in an open window,
the negatives the best rows with other labels in the window below a positive. First the block with
the highest bound is read, which raises what a further row must reach, then the others that still can.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.topk import whole_numbers
from larkspur.operators.ordered import running_sums
from larkspur.session import cut_lineage


class Settings(NamedTuple):
    """Rows of a block, anchors of a group, blocks that a task reads in turn, and levels (2 ** bits) of a dimension on the curve."""

    block_rows: int = 2048
    group_rows: int = 1024
    turns: int = 16
    bits: int = 2


_LOWEST, _HIGHEST = -(2**63), 2**63 - 1
_PACKED = "block string, no bigint, size int, rows int, width int, ids binary, labels binary, vectors binary, low array<bigint>, high array<bigint>, low_label bigint, high_label bigint"


def hilbert_keys(levels: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of whole numbers under 2 ** ``bits`` on the Hilbert curve, as bytes that sort like it.

    Skilling's transform, for all rows at once: rotations and reflections are undone from the highest level
    down, then the Gray code of the transposed index is taken.
    """
    rows, dims = levels.shape
    x = [levels[:, i].astype(np.uint32) for i in range(dims)]
    if not dims:
        return np.zeros((rows, 0), np.uint8)
    for level in range(bits - 1, 0, -1):
        q, below = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(dims):
            is_set = (x[i] & q) != 0
            swap = np.where(is_set, 0, (x[0] ^ x[i]) & below).astype(np.uint32)
            x[0] = x[0] ^ np.where(is_set, below, swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, dims):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(rows, np.uint32)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & np.uint32(1 << level), np.uint32((1 << level) - 1), np.uint32(0))
    planes = [((v ^ turn) >> np.uint32(level)) & np.uint32(1) for level in range(bits - 1, -1, -1) for v in x]
    return np.packbits(np.stack(planes, axis=1).astype(np.uint8), axis=1)


def _matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def _spread_of(clean: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean and deviation of every dimension, for each number of dimensions; each task sends one row for each of them."""

    def partial(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            sizes = batch["size"].to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                points = _matrix(batch["vector"].take(pa.array(np.flatnonzero(sizes == size))), int(size)).astype(np.float64)
                kept = sums.setdefault(int(size), [0, np.zeros(int(size)), np.zeros(int(size))])
                kept[0] += len(points)
                kept[1] += points.sum(axis=0)
                kept[2] += (points**2).sum(axis=0)
        for size, (n, total, squares) in sums.items():
            yield pa.RecordBatch.from_pydict({"size": [size], "n": [n], "total": [total.tolist()], "squares": [squares.tolist()]}, schema=schema)

    schema = pa.schema([("size", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.float64())), ("squares", pa.list_(pa.float64()))])
    sent = clean.select("size", "vector").mapInArrow(partial, "size int, n bigint, total array<double>, squares array<double>")
    summed = sent.select("size", "n", F.posexplode(F.arrays_zip("total", "squares")).alias("at", "x")).groupBy("size", "at").agg(
        F.sum("n").alias("n"), F.sum("x.total").alias("total"), F.sum("x.squares").alias("squares")
    )
    found: dict[int, list] = {}
    for r in summed.orderBy("size", "at").collect():
        mean = r["total"] / r["n"]
        found.setdefault(r["size"], []).append((mean, math.sqrt(max(0.0, r["squares"] / r["n"] - mean * mean))))
    return {size: (np.array([m for m, _ in v]), np.array([d for _, d in v])) for size, v in found.items()}


def _curve(spread: dict[int, tuple[np.ndarray, np.ndarray]], bits: int):
    @F.arrow_udf("binary")
    def key(vectors: pa.Array, sizes: pa.Array) -> pa.Array:
        out: list[bytes] = [b""] * len(vectors)
        size_of = sizes.to_numpy(zero_copy_only=False)
        for size in np.unique(size_of):
            if int(size) not in spread:
                continue
            at = np.flatnonzero(size_of == size)
            mean, deviation = spread[int(size)]
            order = np.argsort(-deviation, kind="stable")
            away = (_matrix(vectors.take(pa.array(at)), int(size)) - mean) / np.where(deviation > 0, deviation, 1)
            # the middle levels are one deviation wide
            levels = np.clip(np.floor(away * (1 << bits) / 4) + (1 << (bits - 1)), 0, (1 << bits) - 1)
            for i, row in zip(at.tolist(), hilbert_keys(levels[:, order], bits)):
                out[i] = row.tobytes()
        return pa.array(out, pa.binary())

    return key


def _pack(table: pa.Table) -> pa.Table:
    size = table["size"][0].as_py()
    table = table.sort_by([("label", "ascending"), ("key", "ascending"), ("id", "ascending")])
    points, labels = _matrix(table["vector"], size), table["label"].to_numpy()
    most = max(abs(int(points.min())), abs(int(points.max()))) if points.size else 0
    corner = pa.list_(pa.int64())
    width = next(w for w in (2, 4, 8) if w == 8 or most < 2 ** (8 * w - 1))
    return pa.table({
        "block": [f"{size}.{table['no'][0].as_py()}"], "no": [table["no"][0].as_py()], "size": pa.array([size], pa.int32()), "rows": pa.array([len(points)], pa.int32()),
        "width": pa.array([width], pa.int32()), "ids": [table["id"].to_numpy().astype("<i8").tobytes()], "labels": [labels.astype("<i8").tobytes()],
        "vectors": [points.astype(f"<i{width}").tobytes()], "low": pa.array([points.min(axis=0).tolist()], corner),
        "high": pa.array([points.max(axis=0).tolist()], corner),
        "low_label": [int(labels.min())], "high_label": [int(labels.max())],
    })


def packed(rows: DataFrame, per_block: int, label: str) -> DataFrame:
    """Blocks of ``per_block`` rows (the last of a size: fewer) along (label, Hilbert key, id), with their zone maps, written.

    A block's number comes from its rows' places in the order, so it holds as many rows however the tables are partitioned.
    """
    placed = running_sums(rows.withColumn("one", F.lit(1).cast("bigint")), ["size"], F.struct("label", "key", "id").asc(), ["one"])
    numbered = placed.withColumn("no", F.floor(F.col("one_before") / per_block)).select("size", "no", "id", "label", "key", "vector")
    return cut_lineage(rows.sparkSession, numbered.groupBy("size", "no").applyInArrow(_pack, _PACKED), label)


def box_bounds(a_low: pa.Array, a_high: pa.Array, b_low: pa.Array, b_high: pa.Array) -> pa.Array:
    """Bounds of the inner products between two boxes of one size, by interval arithmetic, rounded outwards."""
    sizes = np.diff(a_low.offsets.to_numpy())
    flat = [x.flatten().to_numpy(zero_copy_only=False).astype(np.float64) for x in (a_low, a_high, b_low, b_high)]
    corners = np.stack([flat[0] * flat[2], flat[0] * flat[3], flat[1] * flat[2], flat[1] * flat[3]])
    at = np.repeat(np.arange(len(sizes)), sizes)
    least = np.bincount(at, corners.min(axis=0), minlength=len(sizes)) if len(at) else np.zeros(len(sizes))
    most = np.bincount(at, corners.max(axis=0), minlength=len(sizes)) if len(at) else np.zeros(len(sizes))
    slack = 1 + 1e-9 * (np.bincount(at, np.abs(corners).max(axis=0), minlength=len(sizes)) if len(at) else np.zeros(len(sizes)))
    return pa.StructArray.from_arrays([pa.array(least - slack), pa.array(most + slack)], names=["least", "most"])


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
    return ids, labels, np.frombuffer(row["vectors"], f"<i{row['width']}").reshape(row["rows"], row["size"])


def _exact(a: np.ndarray, b: np.ndarray) -> type:
    """A type in which every inner product is exact."""
    most = lambda x: max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    bound = most(a) * most(b) * max(1, a.shape[1])
    return np.float64 if bound < 2**53 else np.int64 if bound < 2**62 else object


class Found:
    """The best rows of one window so far: higher scores first, then smaller ids. ``bar`` is what a further row must reach."""

    __slots__ = ("k", "bar", "high", "rows")

    def __init__(self, k: int, bar: int, high: int):
        self.k, self.bar, self.high, self.rows = k, bar, high, []

    def offer(self, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        good = np.flatnonzero(allowed & (scores >= self.bar) & (scores <= self.high))
        if len(good) > 4 * self.k:
            kth = np.partition(scores[good], len(good) - self.k)[len(good) - self.k]
            good = good[scores[good] >= kth]
        if len(good):
            new = [(-s, i) for s, i in zip(scores[good].tolist(), ids[good].tolist())]
            self.rows = sorted(self.rows + new)[: self.k]
            if len(self.rows) == self.k:
                self.bar = max(self.bar, -self.rows[-1][0])


def _search(k: int, same_label: bool):
    def search(groups: pa.Table, blocks: pa.Table) -> pa.Table:
        out: dict[str, list] = {name: [] for name in ("group", "row", "place", "vec_id", "score")}
        if groups.num_rows and blocks.num_rows:
            group = groups.slice(0, 1).to_pylist()[0]
            ids, labels, points = _unpack(group)
            windows = [(w["row"], w["place"], Found(k, w["bar"], w["high"])) for w in group["windows"]]
            row_of = np.array([w[0] for w in windows])
            high = np.array([w[2].high for w in windows], dtype=np.float64)
            wide = points.astype(np.float64)
            for at in np.argsort(-blocks["most"].to_numpy(), kind="stable").tolist():
                block = blocks.slice(at, 1).to_pylist()[0]
                low_zone, high_zone = np.array(block["low"], np.float64), np.array(block["high"], np.float64)
                up, down = np.maximum(wide * low_zone, wide * high_zone), np.minimum(wide * low_zone, wide * high_zone)
                slack = 1 + 1e-9 * np.maximum(np.abs(up), np.abs(down)).sum(axis=1)
                most, least = up.sum(axis=1) + slack, down.sum(axis=1) - slack
                bars = np.array([w[2].bar for w in windows], dtype=np.float64)
                needed = np.flatnonzero((most[row_of] >= bars) & (least[row_of] <= high))
                if not len(needed):
                    continue
                b_ids, b_labels, b_points = _unpack(block)
                rows, place = np.unique(row_of[needed], return_inverse=True)
                kind = _exact(points, b_points)
                scores = points[rows].astype(kind) @ b_points.astype(kind).T
                if kind is object:
                    scores = np.clip(scores, _LOWEST + 1, _HIGHEST)
                scores = scores.astype(np.int64)
                for w, r in zip(needed.tolist(), place.tolist()):
                    anchor = rows[r]
                    if same_label:
                        allowed = (b_labels == labels[anchor]) & (b_ids != ids[anchor])
                    else:
                        allowed = b_labels != labels[anchor]
                    windows[w][2].offer(scores[r], b_ids, allowed)
            for row, place, found in windows:
                for score, vec in found.rows:
                    out["group"].append(group["block"])
                    out["row"].append(row)
                    out["place"].append(place)
                    out["vec_id"].append(vec)
                    out["score"].append(-score)
        kinds = [("group", pa.string()), ("row", pa.int32()), ("place", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())]
        return pa.table(out, schema=pa.schema(kinds))

    return search


def _pairs(groups: DataFrame, blocks: DataFrame, same_label: bool, label: str) -> DataFrame:
    """Groups and blocks of one size with their bounds: zone maps only, a row for some thousand rows of a table.

    Blocks are dealt into lots of 256, so that no task meets all of them.
    """
    zones = lambda df, to: df.select(
        "size", *(["lot"] if "lot" in df.columns else []), F.col("block").alias(to), *[F.col(c).alias(f"{to}_{c}") for c in ("low", "high", "low_label", "high_label")]
    )
    right = zones(blocks.withColumn("lot", F.floor(F.col("no") / 256)), "in_block")
    lots = right.groupBy("size").agg(F.max("lot").alias("last"))
    left = zones(groups, "in_group").join(lots, "size").withColumn("lot", F.explode(F.sequence(F.lit(0).cast("bigint"), "last")))
    meet = left.join(right, ["size", "lot"])
    overlap = (F.col("in_group_low_label") <= F.col("in_block_high_label")) & (F.col("in_block_low_label") <= F.col("in_group_high_label"))
    one_label = (
        (F.col("in_group_low_label") == F.col("in_group_high_label")) & (F.col("in_block_low_label") == F.col("in_block_high_label"))
        & (F.col("in_group_low_label") == F.col("in_block_low_label"))
    )
    bounds = F.arrow_udf(box_bounds, "struct<least:double,most:double>")("in_group_low", "in_group_high", "in_block_low", "in_block_high")
    found = meet.where(overlap if same_label else ~one_label).select("size", "in_group", "in_block", bounds.alias("bounds"))
    return cut_lineage(groups.sparkSession, found.select("size", "in_group", "in_block", "bounds.least", "bounds.most"), label)


def _best(groups: DataFrame, blocks: DataFrame, windows: DataFrame, k: int, same_label: bool, cfg: Settings, label: str) -> DataFrame:
    """``group, row, place, vec_id, score``: the ``k`` best rows of every window, from the blocks that can hold one of them.

    ``windows`` has ``size, group, row, place, low, high``: scores from ``low`` to ``high`` count. There are no more of
    a group than its rows times the windows of an anchor, so a group's list is bounded.
    """
    spark = groups.sparkSession
    pairs = _pairs(groups, blocks, same_label, f"{label}-pairs")

    def listed(windows: DataFrame) -> DataFrame:
        return windows.groupBy("size", "group").agg(
            F.collect_list(F.struct("row", "place", "bar", "high")).alias("windows"), F.min("bar").alias("worst"), F.max("high").alias("top")
        )

    def visited(which: DataFrame, lists: DataFrame) -> DataFrame:
        key = ["size", "in_group", "lane"]
        asked = which.select(*key).distinct().join(lists.select("size", F.col("group").alias("in_group"), "windows"), ["size", "in_group"])
        left = groups.join(asked.select(*[F.col(c).alias(f"_{c}") for c in [*key, "windows"]]), F.col("block") == F.col("_in_group"))
        left = left.withColumnRenamed("_windows", "windows")
        right = which.join(blocks.withColumnRenamed("block", "in_block"), ["size", "in_block"])
        return left.groupBy(*[f"_{c}" for c in key]).cogroup(right.groupBy(*key)).applyInArrow(
            _search(k, same_label), "group string, row int, place int, vec_id bigint, score bigint"
        )

    def reaching(pairs: DataFrame, lists: DataFrame) -> DataFrame:
        hull = lists.select("size", F.col("group").alias("in_group"), "worst", "top")
        return pairs.join(hull, ["size", "in_group"]).where((F.col("most") >= F.col("worst")) & (F.col("least") <= F.col("top"))).drop("worst", "top")

    order = Window.partitionBy("size", "in_group").orderBy(F.desc("most"), "in_block")
    lists = cut_lineage(spark, listed(windows.withColumn("bar", F.col("low"))), f"{label}-windows")
    ranked = reaching(pairs, lists).withColumn("turn", F.row_number().over(order))
    first = cut_lineage(spark, visited(ranked.where("turn = 1").withColumn("lane", F.lit(0)), lists), f"{label}-first")
    reached = first.groupBy("group", "row", "place").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
    raised = windows.join(reached, ["group", "row", "place"], "left").withColumn("bar", F.greatest("low", F.coalesce("kth", "low")))
    lists = cut_lineage(spark, listed(raised), f"{label}-raised")
    rest = reaching(ranked.where("turn > 1"), lists).withColumn("lane", F.floor((F.row_number().over(order) - 1) / cfg.turns).cast("int"))
    found = first.unionByName(visited(rest, lists))
    best = Window.partitionBy("group", "row", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, anchors: Column, label: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, factor: float = 256.0,
    id_column: str = "vec_id", vector: str = "embedding", settings: Settings = Settings(),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components are turned into floor(``factor`` * x), a score is the integer inner product. The positives of an anchor are its
    ``positives`` best other ids of its label, and for each the ``negatives`` best rows of other labels are returned whose score is
    from ``low`` to ``high`` percent of the positive's; ties go to the smaller id. Rows with a null id or label, and vectors
    that are null or hold a null or non-finite component, take no part; vectors meet those with as many components. A row that
    occurs twice is two candidates; an id that is an anchor twice counts once, with its smallest label and vector. Scores past
    a long count as the nearest long.
    """
    cfg = settings
    spark = vectors.sparkSession
    clean = vectors.select(
        F.col(id_column).cast("bigint").alias("id"), label.cast("bigint").alias("label"), whole_numbers(F.col(vector), factor).alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
    ).where("id is not null and label is not null and vector is not null")
    clean = cut_lineage(spark, clean.withColumn("size", F.size("vector")), "vectors")
    keyed = clean.withColumn("key", _curve(_spread_of(clean), cfg.bits)("vector", "size"))
    blocks = packed(keyed.drop("is_anchor"), cfg.block_rows, "blocks")
    asked = keyed.where("is_anchor").groupBy("id").agg(F.min(F.struct("label", "vector", "size", "key")).alias("one")).select("id", "one.*")
    groups = packed(asked, cfg.group_rows, "groups")

    numbers = F.arrow_udf(lambda raw: pa.array([np.frombuffer(x.as_py(), "<i8").tolist() for x in raw], pa.list_(pa.int64())), "array<bigint>")
    rows = groups.select("size", F.col("block").alias("group"), F.posexplode(numbers("ids")).alias("row", "anchor_id"))
    open_windows = rows.select("size", "group", "row", F.lit(1).alias("place"), F.lit(_LOWEST + 1).alias("low"), F.lit(_HIGHEST).alias("high"))
    near = _best(groups, blocks, open_windows, positives, True, cfg, "positive")
    near = near.select("group", "row", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    near = cut_lineage(spark, near.join(rows, ["group", "row"]), "positives")
    score = F.col("positive_score").cast("decimal(19,0)")
    share = lambda percent, more: F.call_function("div", score * percent + more, F.lit(100).cast("decimal(3,0)"))
    # a window below a negative score is empty
    below = near.where("positive_score >= 0").select(
        "size", "group", "row", "place", share(low, 99).cast("bigint").alias("low"), share(high, 0).cast("bigint").alias("high")
    ).where("low <= high")
    hard = _best(groups, blocks, below, negatives, False, cfg, "negative")
    return hard.join(near.drop("size"), ["group", "row", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
