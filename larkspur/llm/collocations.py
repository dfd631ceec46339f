"""Collocations: phrases whose words stand together far more often than apart, by sorted count streams.

Runs of one to four words are counted, and those that occur often enough are kept in two written
streams: in prefix order (by words from the left) and in suffix order (by words from the right). In
prefix order a run comes right behind its own fronts, so one scan in step with the order has the count
of each front at hand; in suffix order the same holds for the ends. The two are merged by a sort-merge
join. Nothing is looked up in a hash table, and no stream is held in memory.

What is kept shrinks before the shuffle: a first pass counts runs in buckets, saturating at the least
count, in arrays of fixed size that are added up over the tasks. A run whose bucket stays under the
least count cannot reach it. The filter has no false losses: results are the same for any size.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.llm.words import Words, chain, hash_words, slices
from larkspur.operators.ordered import carried
from larkspur.session import cut_lineage, spread


class Settings(NamedTuple):
    """Longest run, least count, percentage at which a longer run takes a phrase in, and 2 ** ``bits`` buckets for each length.

    The arrays of a task take 4 * 2 ** bits bytes for each length, and the map that all tasks get 2 ** bits / 8.
    """

    longest: int = 4
    least: int = 30
    held: int = 80
    bits: int = 23


_CHUNK = 1 << 15

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09]] = True


class Runs(NamedTuple):
    """The words of some texts: their bytes, each with a blank behind it, and an id that stands for word and language.

    ``follows[n]`` tells for each word whether n more come behind it in its piece.
    """

    data: np.ndarray
    begins: np.ndarray
    langs: np.ndarray
    ids: np.ndarray
    hashes: np.ndarray
    follows: list[np.ndarray]


def read_runs(column: pa.Array, langs: np.ndarray, lang_hashes: np.ndarray, longest: int) -> Iterator[Runs]:
    """The runs of each slice of the texts; memory is bounded by a slice or one longer text."""
    for s in slices(column):
        kind_break, inside = _BREAK[s.data], ~(_BREAK | _BLANK)[s.data]
        edge = np.zeros(len(s.data) + 1, dtype=bool)
        edge[s.offsets] = True
        before = np.zeros(len(s.data), dtype=bool)
        before[1:] = inside[:-1]
        begins = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.zeros(len(s.data), dtype=bool)
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        if not len(begins):
            continue
        sizes = ends - begins + 1
        offsets = np.zeros(len(begins) + 1, dtype=np.int64)
        np.cumsum(sizes, out=offsets[1:])
        place = np.arange(offsets[-1], dtype=np.int64) - np.repeat(offsets[:-1] - begins, sizes)
        place[offsets[1:] - 1] = 0
        data = _LOWER[s.data[place]]
        data[offsets[1:] - 1] = 0x20

        text = np.searchsorted(s.offsets, begins, side="right") - 1
        lang = langs[s.first_row : s.first_row + s.rows][text]
        piece = np.zeros(len(s.data) + 1, dtype=np.int64)
        np.cumsum(kind_break, out=piece[1:])
        joins = (piece[begins[1:]] == piece[begins[:-1]]) & (text[1:] == text[:-1])

        packed = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        words = packed.dictionary_encode()
        kept = words.dictionary
        starts = np.frombuffer(kept.buffers()[1], np.int64)[kept.offset : kept.offset + len(kept) + 1]
        raw = np.frombuffer(kept.buffers()[2], np.uint8)
        of_word = hash_words(s._replace(data=raw), Words(starts[:-1], starts[1:] - 1, starts), lower=False)
        word = words.indices.to_numpy().astype(np.int64)
        ids, hashes = word + lang * len(kept), chain(lang_hashes[lang], of_word[word])
        follows = [np.ones(len(begins), dtype=bool)]
        for n in range(1, longest):
            more = np.zeros(len(begins), dtype=bool)
            more[: len(joins)] = joins
            more[: -1] &= follows[-1][1:]
            follows.append(more)
        yield Runs(data, offsets, lang, ids, hashes, follows)


def _run_hashes(runs: Runs, longest: int) -> list[np.ndarray]:
    """For each length the hash of the run that begins at each word; it means nothing where no such run is."""
    out = [runs.hashes]
    for n in range(1, longest):
        longer = runs.hashes.copy()
        if len(longer) > n:
            longer[:-n] = chain(out[-1][:-n], runs.hashes[n:])
        out.append(longer)
    return out


def _languages(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """A number for each row's language, and the hash and the name of each number."""
    coded = column.fill_null("und").dictionary_encode()
    names = coded.dictionary.to_pylist()
    raw = pa.array(names, pa.large_string())
    hashes = np.zeros(0, np.uint64)
    if names:
        offsets = np.frombuffer(raw.buffers()[1], np.int64)[: len(names) + 1]
        data = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] is not None else np.zeros(0, np.uint8)
        whole = next(slices(pa.array(["x"])))
        hashes = np.zeros(len(names), np.uint64)
        filled = np.flatnonzero(offsets[1:] > offsets[:-1])
        if len(filled):
            hashes[filled] = hash_words(whole._replace(data=data), Words(offsets[:-1][filled], offsets[1:][filled], offsets), lower=False)
    return coded.indices.to_numpy().astype(np.int64), hashes, names


def _texts(batch: pa.RecordBatch, longest: int) -> Iterator[tuple[Runs, list[str]]]:
    codes, hashes, names = _languages(batch["lang"])
    for runs in read_runs(batch["text"], codes, hashes, longest):
        yield runs, names


def frequent_buckets(docs: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """For each length (from one word) which buckets hold ``least`` runs or more, as packed bits.

    One pass; each task sends its counts, cut off at ``least``, in compressed chunks, and a chunk's sum is cut off again:
    the sum reaches ``least`` if and only if the true one does. The map is 2 ** bits / 8 bytes for each length.
    """
    cfg = settings
    size, chunk = 1 << cfg.bits, min(_CHUNK, 1 << cfg.bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((cfg.longest, size), dtype=np.int32)
        for batch in batches:
            for runs, _ in _texts(batch, cfg.longest):
                for n, h in enumerate(_run_hashes(runs, cfg.longest)):
                    np.add.at(counts[n], (h[runs.follows[n]] & np.uint64(size - 1)).astype(np.int64), 1)
        for n in range(cfg.longest):
            out: dict[str, list] = {"part": [], "data": []}
            for at in range(0, size, chunk):
                some = counts[n, at : at + chunk]
                if some.any():
                    out["part"].append(n * (size // chunk) + at // chunk)
                    out["data"].append(pa.compress(np.minimum(some, cfg.least).astype(np.uint8).tobytes(), "zstd", asbytes=True))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("part", pa.int32()), ("data", pa.binary())]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = None, np.zeros(chunk, dtype=np.int32)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"part": [part], "data": [np.packbits(total >= cfg.least).tobytes()]}, schema=pa.schema([("part", pa.int32()), ("data", pa.binary())])
            )

        for batch in batches:
            for p, data in zip(batch["part"].to_pylist(), batch["data"]):
                if p != part:
                    if part is not None:
                        yield done()
                    part = p
                    total[:] = 0
                total += np.frombuffer(pa.decompress(data.as_buffer(), chunk, "zstd"), np.uint8)
                np.minimum(total, cfg.least, out=total)
        if part is not None:
            yield done()

    counted = docs.mapInArrow(count, "part int, data binary")
    # a chunk's counts are added up as they come by, so a task holds one chunk however many tasks sent it
    summed = counted.repartition("part").sortWithinPartitions("part").mapInArrow(add, "part int, data binary")
    bits = np.zeros((cfg.longest, size // chunk, (chunk + 7) // 8), dtype=np.uint8)
    for row in summed.collect():
        bits[divmod(row["part"], size // chunk)] = np.frombuffer(row["data"], np.uint8)
    return bits.reshape(cfg.longest, -1)


def count_runs(docs: DataFrame, bits: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """``lang, run, f``: runs of up to ``longest`` words with their counts, joined by blanks, if those reach ``least``.

    The empty run stands for all words of a language. Null languages are ``und``.
    """
    cfg = settings
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = shared.value

        def frequent(n: int, hashes: np.ndarray) -> np.ndarray:
            at = (hashes & np.uint64((1 << cfg.bits) - 1)).astype(np.int64)
            return (maps[n][at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1

        for batch in batches:
            for runs, names in _texts(batch, cfg.longest):
                yield from _counted(runs, names, _run_hashes(runs, cfg.longest), frequent)

    counted = docs.mapInArrow(count, "lang string, run string, f bigint")
    return counted.groupBy("lang", "run").agg(F.sum("f").alias("f")).where((F.col("f") >= cfg.least) | (F.col("run") == ""))


def _counted(runs: Runs, names: list[str], hashes: list[np.ndarray], frequent) -> Iterator[pa.RecordBatch]:
    """The counts of one slice. A run's identity is that of its front and its last word, so no hash decides it."""
    schema = pa.schema([("lang", pa.string()), ("run", pa.string()), ("f", pa.int64())])
    total = np.bincount(runs.langs, minlength=len(names))
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"lang": [names[i] for i in used], "run": [""] * len(used), "f": total[used]}, schema=schema)
    lang_names = pa.array(names, pa.string())
    _, words = np.unique(runs.ids, return_inverse=True)
    n_words = int(words.max()) + 1
    at = np.flatnonzero(frequent(0, hashes[0]))
    front = np.full(len(words), -1, dtype=np.int64)
    front[at] = words[at]
    for n in range(len(hashes)):
        if n:
            # both the front and the rest of a run must be frequent for it to be
            last = np.full(len(words), -1, dtype=np.int64)
            last[:-1] = front[1:]
            at = np.flatnonzero(runs.follows[n] & (front >= 0) & (last >= 0) & frequent(n, hashes[n]))
            keys = front[at] * n_words + words[at + n]
        else:
            keys = words[at]
        if not len(at):
            return
        _, first, inverse, f = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        front = np.full(len(words), -1, dtype=np.int64)
        front[at] = inverse
        begin, end = runs.begins[at[first]], runs.begins[at[first] + n + 1] - 1
        offsets = np.zeros(len(first) + 1, dtype=np.int64)
        np.cumsum(end - begin, out=offsets[1:])
        place = np.arange(offsets[-1], dtype=np.int64) - np.repeat(offsets[:-1] - begin, end - begin)
        text = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(runs.data[place])])
        lang = lang_names.take(pa.array(runs.langs[at[first]]))
        yield pa.RecordBatch.from_arrays([lang, text.cast(pa.string()), pa.array(f)], schema=schema)


def _whole(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(19,0)")


def _streams(spark: SparkSession, counts: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """The runs in prefix order with the counts of their fronts (``front0``…), and in suffix order with those of their ends."""
    words = F.when(F.col("run") == "", F.array().cast("array<string>")).otherwise(F.split("run", " "))
    runs = counts.withColumn("words", words).withColumn("size", F.size("words")).withColumn("back", F.reverse("words"))
    lengths = range(1, longest)
    # a run that is kept occurs no more often than any part of it: every front is kept and lies before it, and no
    # other run of the front's length lies between them
    # the empty run comes first of its language
    fronts = {f"front{k}": F.when(F.col("size") == k, F.col("f")) for k in range(longest)}
    prefix = carried(runs, ["lang", "words"], fronts)
    suffix = carried(runs.where("size > 0"), ["lang", "back"], {f"end{k}": F.when(F.col("size") == k, F.col("f")) for k in lengths})
    return prefix, suffix


def phrases(docs: DataFrame, settings: Settings = Settings(), lang: str = "lang", text: str = "text") -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of every phrase that is not taken in by a longer one.

    Phrases are runs of two words or more that occur ``least`` times or more within pieces (split at ``.,;:!?`` and line
    ends; words are split at blanks and tabs, A-Z count as a-z). ``a`` is the phrase's count, ``l`` and ``r`` those of its
    two parts at the cut with the lowest score (of equal ones the first), ``n`` the number of words of the language, and
    ``score`` floor(2,000,000 a / (l + r)). A phrase is dropped if a longer run with at least ``held`` percent of
    its count holds it. Counts are exact; null texts are empty, a null language is ``und``, repeated rows count each time.
    """
    cfg = settings
    spark = docs.sparkSession
    texts = spread(docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")))
    counts = cut_lineage(spark, count_runs(texts, frequent_buckets(texts, cfg), cfg), "counts")
    prefix, suffix = _streams(spark, counts, cfg.longest)
    prefix = prefix.where("size > 1").select("lang", "run", "size", "f", *[f"front{k}" for k in range(cfg.longest)])
    suffix = suffix.where("size > 1").select(F.col("lang").alias("_lang"), F.col("run").alias("_run"), *[f"end{k}" for k in range(1, cfg.longest)])
    same = (F.col("lang") == F.col("_lang")) & (F.col("run") == F.col("_run"))
    # in step: both sides sorted by run
    merged = cut_lineage(spark, prefix.join(suffix.hint("merge"), same).drop("_lang", "_run"), "merged")

    # a run that holds a phrase with two words more has one in between that holds it as often or more
    taken = []
    for size in range(3, cfg.longest + 1):
        longer = merged.where(F.col("size") == size)
        words = F.split("run", " ")
        for part, count in ((F.slice(words, 1, size - 1), f"front{size - 1}"), (F.slice(words, 2, size - 1), f"end{size - 1}")):
            holds = 100 * _whole("f") >= cfg.held * _whole(count)
            taken.append(longer.where(holds).select(F.col("lang").alias("_lang"), F.array_join(part, " ").alias("_run")))
    kept = merged
    if taken:
        every = taken[0]
        for more in taken[1:]:
            every = every.unionByName(more)
        kept = merged.join(every.hint("merge"), same, "left_anti")

    cuts = []
    for k in range(1, cfg.longest):
        rest = F.element_at(F.array(*[F.col(f"end{i}") for i in range(1, cfg.longest)]), F.greatest(F.lit(1), F.col("size") - k))
        ratio = F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * _whole("f"), _whole(f"front{k}") + _whole(rest))
        cuts.append(F.when(F.col("size") > k, F.struct(ratio.cast("bigint").alias("score"), F.lit(k).alias("k"), F.col(f"front{k}").alias("l"), rest.alias("r"))))
    lowest = F.array_min(F.array(*cuts))
    return kept.withColumn("cut", lowest).select(
        "lang", F.col("run").alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", F.col("front0").alias("n"), "cut.score"
    )


def top_phrases(docs: DataFrame, first: int, settings: Settings = Settings()) -> DataFrame:
    """The ``first`` phrases of each language with their ``rank``: by score, then count, then the phrase's bytes."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = phrases(docs, settings).withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
