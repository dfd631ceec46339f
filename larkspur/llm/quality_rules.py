"""Quality rules: compression bands, with the counts that plain rules need.

Repetitive text compresses far better than prose and random text far worse. Both
ends are cut off: what compresses no better than its single bytes allow is noise in any alphabet, and
ratios out of their band fail: for the whole text, with limits by its length (short texts carry
the frame's overhead, long ones gain from their own history), and for its chunks of
a fixed size, the last one aligned to the text's end, so that one long run of either kind
in a good text is found too.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.words import chain, find_words, hash_words, in_words, mix, per_text, slices


class Band(NamedTuple):
    """Texts of fewer than ``below`` bytes (None: any) have a ratio from ``low`` to ``high``."""

    below: int | None
    low: float
    high: float


#: Ratio of zstandard's bytes to the text's own. Prose of any length stays well inside.
BANDS = (
    Band(128, 0.35, 2.00),
    Band(256, 0.32, 1.10),
    Band(512, 0.30, 0.92),
    Band(1024, 0.28, 0.84),
    Band(4096, 0.25, 0.78),
    Band(16384, 0.20, 0.74),
    Band(None, 0.15, 0.72),
)
CHUNK_BYTES = 4096
CHUNK_BAND = Band(None, 0.20, 0.76)
class Noise(NamedTuple):
    """Ratio by the entropy of single bytes, above which there is nothing in the text but its alphabet.

    A compressor that finds no repeats gets no further than that entropy, whatever the alphabet: digits, letters or ideographs.
    ``chunk`` and ``whole`` hold for mostly one-byte text, the ``wide`` ones where a share of ``wide_share`` of the bytes belongs to
    longer characters, whose first bytes repeat. Texts under ``least`` bytes cannot be told apart so.
    """

    chunk: float = 1.0
    whole: float = 0.995
    wide_chunk: float = 0.96
    wide_whole: float = 0.92
    wide_share: float = 0.3
    least: int = 4096


NOISE = Noise()
#: The share of a text's whole chunks that may lie outside the chunk band.
MAX_BAD_CHUNKS = 0.25

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_BLANKS = " \t\n\v\f\r"

MEASURES = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
    "n_bytes:bigint,ratio:double,n_chunks:bigint,low_chunks:bigint,high_chunks:bigint,"
    "low_tail:bigint,high_tail:bigint,noisy_chunks:bigint,noisy:bigint>"
)


def _repeated_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text, the words that lie in a 3-word window whose words occur twice or more in it."""
    text_of = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    covered = np.zeros(len(hashes), dtype=bool)
    if len(hashes) >= 3:
        window = chain(chain(hashes[:-2], hashes[1:-1]), hashes[2:])
        whole = np.flatnonzero(text_of[:-2] == text_of[2:])
        keyed = window[whole] ^ mix(text_of[whole])
        _, place, count = np.unique(keyed, return_inverse=True, return_counts=True)
        again = whole[count[place] > 1]
        for i in range(3):
            covered[again + i] = True
    return per_text(covered, first)


def _repeated_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def is_noise(raw: np.ndarray, ratio: float, noise: Noise, whole: bool) -> bool:
    """Whether bytes that compress to a ratio have nothing that repeats beyond single bytes."""
    if len(raw) < noise.least or ratio < 0.3:
        return False
    counts = np.bincount(raw, minlength=256)
    share = counts[counts > 0] / len(raw)
    entropy = -float((share * np.log2(share)).sum()) / 8
    wide = counts[128:].sum() >= noise.wide_share * len(raw)
    limit = (noise.wide_whole if wide else noise.whole) if whole else (noise.wide_chunk if wide else noise.chunk)
    return ratio > limit * entropy


def measure(
    texts: pa.Array, level: int = 3, chunk_bytes: int = CHUNK_BYTES, chunk_band: Band = CHUNK_BAND, noise: Noise = NOISE
) -> pa.Array:
    """The measures of ``MEASURES`` for each text; a null text counts as empty and has ratio 1.

    What whole chunks leave over at the end of a text is measured as the tail: a chunk that ends with the text.
    """
    squeeze = zstandard.ZstdCompressor(level=level, write_checksum=False).compress
    columns: dict[str, list] = {x.split(":")[0]: [] for x in MEASURES[7:-1].split(",")}
    for s in slices(texts):
        words = find_words(s)
        letters = in_words(s) & ((s.data & 0xC0) != 0x80)
        columns["n_words"].append(np.diff(words.first))
        columns["word_chars"].append(per_text(letters, s.offsets))
        columns["n_symbols"].append(per_text(_SYMBOL[s.data], s.offsets))
        columns["n_repeat_words"].append(_repeated_words(hash_words(s, words, lower=False), words.first))
        dup, size, ratio, chunks, low, high, low_tail, high_tail, noisy_chunks, noisy = ([] for _ in range(10))
        for begin, end in zip(s.offsets[:-1].tolist(), s.offsets[1:].tolist()):
            raw = s.data[begin:end].tobytes()
            dup.append(_repeated_lines(raw.decode()))
            size.append(len(raw))
            ratio.append(len(squeeze(raw)) / len(raw) if raw else 1.0)
            parts = [len(squeeze(raw[i : i + chunk_bytes])) / chunk_bytes for i in range(0, len(raw) - chunk_bytes + 1, chunk_bytes)]
            chunks.append(len(parts))
            low.append(sum(x < chunk_band.low for x in parts))
            high.append(sum(x > chunk_band.high for x in parts))
            tail = len(squeeze(raw[-chunk_bytes:])) / chunk_bytes if parts and len(raw) % chunk_bytes else None
            low_tail.append(tail is not None and tail < chunk_band.low)
            high_tail.append(tail is not None and tail > chunk_band.high)
            own = s.data[begin:end]
            pieces = [(own[i * chunk_bytes : (i + 1) * chunk_bytes], x) for i, x in enumerate(parts)] + ([(own[-chunk_bytes:], tail)] if tail is not None else [])
            noisy_chunks.append(sum(is_noise(piece, x, noise, False) for piece, x in pieces))
            noisy.append(is_noise(own, ratio[-1], noise, True))
        names = ("n_dup_lines", "n_bytes", "ratio", "n_chunks", "low_chunks", "high_chunks", "low_tail", "high_tail", "noisy_chunks", "noisy")
        for name, values in zip(names, (dup, size, ratio, chunks, low, high, low_tail, high_tail, noisy_chunks, noisy)):
            columns[name].append(np.asarray(values))
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate(v or [np.zeros(0)]), type=pa.float64() if k == "ratio" else pa.int64()) for k, v in columns.items()],
        names=list(columns),
    )


def text_measures(text: str | Column, level: int = 3, chunk_bytes: int = CHUNK_BYTES, chunk_band: Band = CHUNK_BAND) -> Column:
    """One struct per row with the fields of ``MEASURES``."""

    @F.arrow_udf(MEASURES)
    def measures(texts: pa.Array) -> pa.Array:
        return measure(texts, level, chunk_bytes, chunk_band)

    return measures(text)


def within_bands(m: Column, bands: Sequence[Band] = BANDS, max_bad_chunks: float = MAX_BAD_CHUNKS) -> Column:
    """Whether measured texts lie in the band of their length, and enough of their chunks in theirs, without and with the tail.

    Not a single chunk may be noise.
    """
    verdict = F.lit(True)
    for band in sorted(bands, key=lambda b: float("inf") if b.below is None else b.below, reverse=True):
        fits = m["ratio"].between(band.low, band.high)
        verdict = fits if band.below is None else F.when(m["n_bytes"] < band.below, fits).otherwise(verdict)
    bad = m["low_chunks"] + m["high_chunks"]
    bad_tail = m["low_tail"] + m["high_tail"]
    verdict = verdict & (m["noisy_chunks"] + m["noisy"] == 0)
    return verdict & (bad <= m["n_chunks"] * max_bad_chunks) & ((bad_tail == 0) | (bad + bad_tail <= (m["n_chunks"] + 1) * max_bad_chunks))


def compression_bands(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", bands: Sequence[Band] = BANDS,
    level: int = 3, chunk_bytes: int = CHUNK_BYTES, chunk_band: Band = CHUNK_BAND, max_bad_chunks: float = MAX_BAD_CHUNKS,
) -> DataFrame:
    """One row per row of ``docs``: its id, a struct ``measures`` and ``in_bands``.

    A narrow step: nothing is shuffled, and every row is measured by itself. Only the
    two named columns are read, so others may have any name. A null or empty text has no
    words and ratio 1, so it is in its band; ids may be null or repeat; an empty table
    gives an empty one. A text is compressed as a whole, in memory for one text at a time.
    """
    measured = docs.select(
        F.col(id_column), text_measures(F.col(text), level, chunk_bytes, chunk_band).alias("measures")
    )
    return measured.select(id_column, "measures", within_bands(F.col("measures"), bands, max_bad_chunks).alias("in_bands"))
