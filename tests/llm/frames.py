"""Small document tables for the tests: the given one, and one of odd rows."""

from __future__ import annotations

import re

import pyarrow.parquet as pq

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, id int, row int, n_words int, score string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

PROSE = " ".join(f"word{i * 7 % 101} and{i % 13} then{i % 29}" for i in range(60))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    texts = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two"), (6, PROSE), (7, PROSE), (7, PROSE), (8, PROSE + " more"),
        (9, "x" * 70_000), (10, "ab " * 40_000), (11, "É ünïcode 中文 \x85 mixed THE the The"), (12, "same line\nsame line\n\nother\nsame line"),
        (None, "no id here"), (None, None), (13, "mail a.b@c.org or +1 415 555 2671"), (14, "\x00 odd \x1f signs \x7f"), (14, "other text of one id"),
    ]
    rest = [("en", "a", 1), (None, None, None), ("fr", "a", 0)]
    return [(i, t, *rest[k % 3], "yes", k, k, 3, "s") for k, (i, t) in enumerate(texts)]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def documents() -> list[dict]:
    return pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()


def words(text: str | None, lower: bool = True) -> list[str]:
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)
