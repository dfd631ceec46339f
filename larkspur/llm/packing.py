"""Best-fit packing: token sequences of a fixed capacity filled with whole documents.

Lengths are whole numbers up to the capacity, so a corpus of any size is a histogram with
that many counts. The packing is worked out on the histogram, for all documents of a length
at once: lengths over a third of the capacity are matched greedily, at most two to a bin, each
with the longest that still fits; smaller ones then go, longest first, into the tightest gap.
The result is a list of ranges ("the n-th to m-th document of this length lie in those bins at
this place") whose size depends on the capacity alone. Documents find their place by their
rank among those of their length: a count within the task that wrote them, plus the counts of
the tasks before. No document passes through the driver.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.words import Slice, slices
from larkspur.session import cut_lineage

CAPACITY = 2048
END_ID = 0
#: Distinct units, and ids of units, that a worker remembers before it begins anew.
UNITS_KEPT, IDS_KEPT = 300_000, 4_000_000
LONG_UNIT = 64
#: Texts are encoded in runs of about so many bytes; the longer, the fewer units are looked up twice.
RUN_BYTES = 6 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
#: How byte-level vocabularies write bytes: visible Latin-1 signs as they are, the others from U+0100 on.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_SIGNS = {b: chr(b) for b in _VISIBLE} | {b: chr(0x100 + i) for i, b in enumerate(x for x in range(256) if x not in _VISIBLE)}


class Encoder:
    """Token ids of texts by a tokenizer file, each distinct unit encoded once.

    A unit begins at a text's start, at a space before a visible ASCII sign or a Latin letter, or at
    any other ASCII sign that follows an ASCII letter. The byte-level pre-tokeniser never joins signs
    across such a place, so the ids of a text are those of its units in turn. Where a special token's
    string occurs, whole texts are the units.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.begins, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _units(self, s: Slice) -> tuple[pa.Array, np.ndarray]:
        data = s.data
        solid = ((data > 0x20) & (data < 0x7F)) | (data == 0xC3)
        cut = np.zeros(len(data), dtype=bool)
        cut[:-1] = (data[:-1] == 0x20) & solid[1:]
        ends = s.offsets[1:-1]
        cut[ends[ends > 0] - 1] = False
        letter = _LETTER[data]
        cut[1:] |= letter[:-1] & ~letter[1:] & (data[1:] < 0x80)
        raw = data.tobytes()
        if any(t in raw for t in self.special):
            cut[:] = False
        cut[s.offsets[:-1][s.offsets[:-1] < len(data)]] = True
        begins = np.flatnonzero(cut)
        bounds = np.append(begins, len(data)).astype(np.int64)
        units = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(bounds), pa.py_buffer(raw))
        return units, np.searchsorted(begins, s.offsets)

    def _encode_units(self, units: list[str]) -> list[list[int]]:
        """Words go to the merge table at once; all else takes the whole way, with special tokens and the pattern."""
        out: list = [None] * len(units)
        other = []
        for i, u in enumerate(units):
            if (u[1:] if u[:1] == " " else u).isalpha():
                signs = u.replace(" ", _BYTE_SIGNS[32]) if u.isascii() else "".join([_BYTE_SIGNS[b] for b in u.encode()])
                out[i] = [t.id for t in self.tokenizer.model.tokenize(signs)]
            else:
                other.append(i)
        for i, e in zip(other, self.tokenizer.encode_batch_fast([units[i] for i in other], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def encode(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin (and the last end)."""
        if not len(s.data):
            return np.zeros(0, np.uint32), np.zeros(s.rows + 1, np.int64)
        if len(self.place) > UNITS_KEPT or len(self.ids) > IDS_KEPT:
            self._forget()
        units, first = self._units(s)
        coded = units.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        where = np.fromiter((self.place.get(u, -1) for u in distinct), np.int64, len(distinct))
        new = np.flatnonzero(where < 0)
        if len(new):
            found = self._encode_units([distinct[i] for i in new])
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            where[new] = np.arange(len(new)) + len(self.sizes)
            for i in new:
                if len(distinct[i]) <= LONG_UNIT:
                    self.place[distinct[i]] = int(where[i])
            self.begins = np.append(self.begins, len(self.ids) + np.cumsum(sizes) - sizes)
            self.sizes = np.append(self.sizes, sizes)
            self.ids = np.append(self.ids, np.fromiter((x for ids in found for x in ids), np.uint32, int(sizes.sum())))
        unit = where[coded.indices.to_numpy()]
        sizes = self.sizes[unit]
        after = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.begins[unit] - after[:-1], sizes) + np.arange(after[-1])]
        return ids, after[first]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One per worker process: reading the vocabulary takes longer than a batch."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(length: int, capacity: int) -> list[tuple[int, int]]:
    """Where a document of that many tokens is cut: only if longer than the capacity, the short piece first."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity
    bounds = [0, *range(first or capacity, length + 1, capacity)]
    return list(zip(bounds[:-1], bounds[1:]))


class Range(NamedTuple):
    """``count`` documents of a length, from the given rank on: ``per_bin`` side by side in each bin, from ``first_bin``."""

    length: int
    rank: int
    count: int
    first_bin: int
    per_bin: int
    offset: int


def plan(counts: dict[int, int], capacity: int) -> list[Range]:
    """A place for every document of a histogram of lengths from 1 to the capacity."""
    left = {n: c for n, c in counts.items() if c > 0}
    ranks = dict.fromkeys(left, 0)
    out: list[Range] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # free tokens: runs of bins (first, count)
    sizes: list[int] = []  # the free sizes there are, in order
    bins = 0

    def free(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, count))

    def put(length: int, count: int, first: int, per_bin: int, offset: int) -> None:
        out.append(Range(length, ranks[length], count, first, per_bin, offset))
        ranks[length] += count
        left[length] -= count

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        at = bisect_right(large, capacity - a) - 1
        if at >= 0 and large[at] == a and left[a] == 1:
            at -= 1
        if at < 0:
            n = left[a]
            free(capacity - a, bins, n)
            put(a, n, bins, 1, 0)
        else:
            b = large[at]
            n = left[a] // 2 if a == b else min(left[a], left[b])
            put(a, n, bins, 1, 0)
            put(b, n, bins, 1, a)
            free(capacity - a - b, bins, n)
            if not left[b] and b != a:
                large.pop(at)
        bins += n
        if not left[a]:
            large.pop()

    for s in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[s]:
            at = bisect_left(sizes, s)
            if at == len(sizes):
                each = capacity // s
                free(capacity, bins, -(-left[s] // each))
                bins += -(-left[s] // each)
                continue
            gap = sizes[at]
            first, count = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                sizes.pop(at)
            each = gap // s
            full = min(count, left[s] // each)
            if full:
                put(s, full * each, first, each, capacity - gap)
                free(gap - each * s, first, full)
            rest = min(left[s], each) if full < count else 0
            if rest:
                put(s, rest, first + full, rest, capacity - gap)
                free(gap - rest * s, first + full, 1)
                full += 1
            free(gap, first + full, count - full)
    return out



def _cut_texts(path: str, capacity: int, end_id: int, keep_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for s in slices(batch.column("text"), RUN_BYTES):
                ids, first = encoder.encode(s)
                rows: list[tuple] = []
                kept: list[np.ndarray] = []
                for i in range(s.rows):
                    own = np.append(ids[first[i] : first[i + 1]], np.uint32(end_id))
                    for k, (begin, end) in enumerate(pieces(len(own), capacity)):
                        piece = own[begin:end]
                        rows.append((s.first_row + i, k, begin, end - begin, zlib.crc32(piece.astype("<u4").tobytes()), int(seen[end - begin])))
                        seen[end - begin] += 1
                        if keep_ids:
                            kept.append(piece.astype(np.int32))
                row, piece, start, length, crc, place = (np.array(x, dtype=np.int64) for x in zip(*rows))
                columns = [
                    batch.column("id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                    pa.array(crc), pa.array(place), pa.array(np.full(len(row), part, dtype=np.int32)),
                ]
                names = ["id", "piece", "start", "length", "ids_crc32", "place", "part"]
                if keep_ids:
                    columns.append(pa.array(kept, type=pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def pack(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    end_id: int = END_ID, keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, its ids.

    ``tokenizer`` is a file that the executors can read. A null or empty text is one piece that holds the
    end alone. Rows are packed one by one, so repeated ids or texts are several documents; null ids
    stay null; an empty table gives an empty one. Columns other than the two are not read. Sequences
    are gapless from 0; which of the documents of a length lies where is not defined.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, place bigint, part int"
    schema += ", ids array<int>" if keep_ids else ""
    named = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    cut = cut_lineage(spark, named.mapInArrow(_cut_texts(tokenizer, capacity, end_id, keep_ids), schema), "pieces")

    tasks = cut.groupBy("part", "length").agg((F.max("place") + 1).alias("count"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counted = cut_lineage(spark, tasks.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))), "ranks")
    # at most one count for each length up to the capacity
    totals = counted.groupBy("length").agg(F.sum("count").alias("count")).collect()
    ranges = sorted(plan({r["length"]: r["count"] for r in totals}, capacity))
    shared = spark.sparkContext.broadcast(np.array(ranges, dtype=np.int64).reshape(-1, len(Range._fields)))

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place_of(length: pa.Array, rank: pa.Array) -> pa.Array:
        table = shared.value
        n, r = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        found = np.searchsorted((table[:, 0] << 40) + table[:, 1], (n << 40) + r, side="right") - 1
        _, begin, _, first, each, offset = table[found].T
        inside = r - begin
        return pa.StructArray.from_arrays(
            [pa.array(first + inside // each), pa.array(offset + inside % each * n)], names=["sequence_id", "offset"]
        )

    ranked = cut.join(counted.select("part", "length", "before"), ["part", "length"])
    placed = ranked.withColumn("at", place_of(F.col("length"), F.col("before") + F.col("place")))
    return placed.select(
        F.col("id").alias(id_column), "piece", "start", "length", "ids_crc32",
        F.col("at.sequence_id").alias("sequence_id"), F.col("at.offset").alias("offset"), *(["ids"] if keep_ids else []),
    )
