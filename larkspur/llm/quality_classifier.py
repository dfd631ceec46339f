"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal.

A text's features are hashes of its words, its word pairs, the shapes of both (letters
and digits folded to one sign each, so that unseen words still count), and one mark for
each word that ends a run of three words already seen in the text. A feature's value is
its share of all, so a score is the mean weight of a text's features: one sparse dot
product, found by looking weights up in an array of fixed size.

Training takes a bounded sample of labelled rows. Every shard of it learns on its own by
follow-the-regularised-leader updates; the shards' weights are averaged, which is a single
sum by feature over at most ``shards`` x ``buckets`` rows. The weights have a fixed size
whatever the corpus, so they are sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.words import Slice, Words, chain, find_words, hash_words, in_words, mix, slices

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a") : ord("z") + 1] = ord("a")
_SHAPE[0x80:] = ord("a")
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("0") : ord("9") + 1] = ord("0")


class Settings(NamedTuple):
    """``alpha``, ``beta``, ``l1`` and ``l2`` are those of FTRL-proximal; ``sample`` bounds the rows learnt from."""

    bits: int = 18
    sample: int = 20_000
    shards: int = 8
    epochs: int = 4
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.0005
    l2: float = 0.001
    scale: float = 16.0


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    settings: Settings


def _shapes(s: Slice, w: Words) -> np.ndarray:
    """Hashes of the words' shapes, runs of one sign folded: ``Ab12--`` gives ``Aa0-``."""
    sign = _SHAPE[s.data]
    keep = np.ones(len(sign), dtype=bool)
    keep[1:] = sign[1:] != sign[:-1]
    keep |= ~in_words(s)
    keep[w.begins] = True
    place = np.zeros(len(sign) + 1, dtype=np.int64)
    np.cumsum(keep, out=place[1:])
    folded = Slice(s.first_row, s.rows, sign[keep], place[s.offsets])
    return hash_words(folded, find_words(folded), lower=False)


def features(s: Slice, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all features, text after text, and where each text's begin (and the last end).

    A text's features are one for having any, then those of its words. Texts without words have the first alone.
    """
    w = find_words(s)
    words, shapes = hash_words(s, w), _shapes(s, w)
    text_of = np.repeat(np.arange(s.rows, dtype=np.int64), np.diff(w.first))
    kinds, owners = [], []

    def add(hashes: np.ndarray, owner: np.ndarray, kind: int) -> None:
        kinds.append(mix(hashes + np.uint64(kind)) >> np.uint64(64 - bits))
        owners.append(owner)

    add(np.zeros(s.rows, np.uint64), np.arange(s.rows), 1)
    add(words, text_of, 2)
    add(shapes, text_of, 3)
    if len(words) > 1:
        pair = np.flatnonzero(text_of[:-1] == text_of[1:])
        add(chain(words[:-1], words[1:])[pair], text_of[pair], 4)
        add(chain(shapes[:-1], shapes[1:])[pair], text_of[pair], 5)
    if len(words) > 2:
        run = np.flatnonzero(text_of[:-2] == text_of[2:])
        keyed = chain(chain(words[:-2], words[1:-1]), words[2:])[run] ^ mix(text_of[run].astype(np.uint64))
        _, seen_first = np.unique(keyed, return_index=True)
        again = np.ones(len(run), dtype=bool)
        again[seen_first] = False
        add(np.zeros(int(again.sum()), np.uint64), text_of[run][again], 6)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(kinds)[order].astype(np.int64), np.searchsorted(owner[order], np.arange(s.rows + 1))


def score_texts(texts: pa.Array, model: Model) -> pa.Array:
    """The probability of label 1 for each text."""
    out = []
    for s in slices(texts):
        index, first = features(s, model.settings.bits)
        total = np.add.reduceat(model.weights[index], first[:-1])
        out.append(model.bias + model.settings.scale * total / np.diff(first))
    margin = np.clip(np.concatenate(out) if out else np.zeros(0), -35, 35)
    return pa.array(1.0 / (1.0 + np.exp(-margin)), type=pa.float64())


def _learn(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int, cfg: Settings) -> tuple[np.ndarray, float]:
    """FTRL-proximal over one shard, several times in shuffled order; the last slot is the bias."""
    size = 1 << cfg.bits
    z, n, w = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    rng = np.random.default_rng(seed)
    for _ in range(cfg.epochs):
        for i in rng.permutation(len(texts)):
            index, value = texts[i]
            zi, ni = z[index], n[index]
            wi = -(zi - np.sign(zi) * cfg.l1) / ((cfg.beta + np.sqrt(ni)) / cfg.alpha + cfg.l2)
            wi[np.abs(zi) <= cfg.l1] = 0.0
            p = 1.0 / (1.0 + np.exp(-np.clip(wi @ value, -35, 35)))
            g = (p - labels[i]) * value
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / cfg.alpha
            z[index], n[index] = zi + g - sigma * wi, ni + g * g
    w = -(z - np.sign(z) * cfg.l1) / ((cfg.beta + np.sqrt(n)) / cfg.alpha + cfg.l2)
    w[np.abs(z) <= cfg.l1] = 0.0
    return w[:-1], float(w[-1])


def _shard_weights(cfg: Settings):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels, seed = [], [], 0
        for batch in batches:
            labels += batch.column("label").to_pylist()
            for s in slices(batch.column("text")):
                index, first = features(s, cfg.bits)
                for begin, end in zip(first[:-1], first[1:]):
                    key, count = np.unique(index[begin:end], return_counts=True)
                    texts.append((np.append(key, 1 << cfg.bits), np.append(cfg.scale * count / (end - begin), 1.0)))
        if not texts:
            return
        weights, bias = _learn(texts, np.asarray(labels, dtype=float), seed, cfg)
        used = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(weights[used], bias)), pa.array(np.ones(len(used) + 1, dtype=np.int64))],
            names=["feature", "weight", "shards"],
        )

    return train


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality", settings: Settings = Settings()) -> Model:
    """Learn from the labelled rows, or from ``settings.sample`` of them picked by a hash of their id.

    A document with several labels counts with the more frequent one (1 in a tie); rows whose
    id or label is null teach nothing, nor do labels without a document. Of documents with one id that
    whose text has the smallest hash teaches. Without any label the model gives 0.5 to all.
    """
    one_label = (
        labels.where(F.col(id_column).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(id_column).alias("id"))
        .agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label"))
    )
    order = F.xxhash64(F.col("id").cast("string"))
    sample = one_label.orderBy(order, "id").limit(settings.sample)
    # the sample has a fixed bound, so it may be sent to the tasks and the texts are not shuffled
    labelled = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(sample), "id")
    learnt = (
        labelled.groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text"))
        .withColumn("shard", F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(7)), F.lit(settings.shards)))
        .repartition(settings.shards, "shard")
        .sortWithinPartitions(order, "id")
        .select("text", "label")
        .mapInArrow(_shard_weights(settings), "feature bigint, weight double, shards bigint")
        .groupBy("feature")
        .agg(F.sum("weight").alias("weight"))
    )
    rows = learnt.toArrow()
    feature, weight = rows["feature"].to_numpy(), rows["weight"].to_numpy()
    shards = max(1, settings.shards)
    weights = np.zeros(1 << settings.bits)
    known = feature >= 0
    weights[feature[known]] = weight[known] / shards
    bias = float(weight[~known].sum() / shards)
    return Model(weights, bias, settings)


def score(model: Model, text: str | Column) -> Column:
    """A column with the probability of label 1 for each text, null and empty ones too."""
    from pyspark.sql import SparkSession

    shared = SparkSession.active().sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        return score_texts(texts, shared.value)

    return probability(text)


def quality_scores(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, score from 0 to 1, predicted 0 or 1. Other columns are not read."""
    scored = docs.select(F.col(id_column), score(model, F.col(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
