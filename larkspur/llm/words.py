"""Words of many texts at once, found with numpy over the UTF-8 bytes of an Arrow column.

A word is a run of characters other than space and U+0009 to U+000D. All separators are
ASCII, so they are looked for in the bytes; no text is turned into Python strings.
Null texts count as empty. Memory per call is bounded by the slice, whose size is that of
``SLICE_BYTES`` or of one text that is longer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
#: Words of more bytes are hashed one by one.
LONG_WORD = 1 << 12

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_AS_IS = np.arange(256, dtype=np.uint8)
_LOWER = _AS_IS.copy()
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers: the finaliser of splitmix64, one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_FACTORS = mix(np.arange(1, LONG_WORD + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class Slice(NamedTuple):
    """Some whole texts: their rows in the column, their bytes, and where each begins (and the last ends)."""

    first_row: int
    rows: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """``begins`` and ``ends`` are byte positions; text i has the words first[i] to first[i + 1] - 1."""

    begins: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def slices(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """The column in runs of whole texts of about ``slice_bytes``; every row is in exactly one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + slice_bytes, side="right")) - 1
        end = min(n, max(end, row + 1))
        yield Slice(row, end - row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the flagged bytes (or the sum of numbers) each text has."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def find_words(s: Slice) -> Words:
    """Where the words of the texts lie; a word never runs on from one text into the next."""
    inside = ~_SEPARATOR[s.data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    starts = s.offsets[:-1][s.offsets[:-1] < len(s.data)]
    begin[starts] = inside[starts]
    lasts = s.offsets[1:][s.offsets[1:] > 0] - 1
    end[lasts] = inside[lasts]
    begins = np.flatnonzero(begin)
    return Words(begins, np.flatnonzero(end) + 1, np.searchsorted(begins, s.offsets))


def in_words(s: Slice) -> np.ndarray:
    """For each byte whether it belongs to a word."""
    return ~_SEPARATOR[s.data]


def hash_words(s: Slice, w: Words, lower: bool = True) -> np.ndarray:
    """A 64-bit hash for each word: a multilinear hash of its bytes, then mixed.

    Equal words have equal hashes everywhere. Two different words have equal ones with
    a chance below 2 ** -56. With ``lower`` A to Z count as a to z.
    """
    fold = _LOWER if lower else _AS_IS
    lengths = w.ends - w.begins
    out = np.zeros(len(lengths), dtype=np.uint64)
    long = np.flatnonzero(lengths > LONG_WORD)
    for i in long:
        raw = fold[s.data[w.begins[i] : w.ends[i]]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
    short = np.flatnonzero(lengths <= LONG_WORD)
    if len(short):
        size = lengths[short]
        before = np.zeros(len(size), dtype=np.int64)
        np.cumsum(size[:-1], out=before[1:])
        place = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(before, size)
        value = fold[s.data[np.repeat(w.begins[short], size) + place]].astype(np.uint64) + np.uint64(1)
        value *= _FACTORS[place]
        out[short] = np.add.reduceat(value, before) + size.astype(np.uint64)
    return mix(out)


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a sequence from those of its front and of its last element."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words of one text; shorter texts give one run of all their words."""
    n = min(size, len(words))
    if not n:
        return words
    out = words[: len(words) - n + 1]
    for i in range(1, n):
        out = chain(out, words[i : len(words) - n + 1 + i])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)
