import re
from collections import Counter

import numpy as np
import pytest

from larkspur.llm import collocations as co
from larkspur.llm.queries import QUERIES
from tests.llm.frames import LOWER, SF_DIR, documents, no_docs, odd_docs, odd_rows

PIECE = re.compile(r"[.,;:!?\x0A-\x0D]")
TOKEN = re.compile(r"[^\x20\x09]+")


def counted(rows):
    """f of every run of one to four words by language; the empty run has the number of words."""
    out = Counter()
    for text, lang in rows:
        for piece in PIECE.split((text or "").translate(LOWER)):
            ws = TOKEN.findall(piece)
            lang = "und" if lang is None else lang
            out[lang, ()] += len(ws)
            for n in range(1, 5):
                for i in range(len(ws) - n + 1):
                    out[lang, tuple(ws[i : i + n])] += 1
    return out


def brute(rows, least=30, first=2000):
    f = counted(rows)
    good = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = set()
    for (lang, ws), a in good.items():
        for n in range(2, len(ws)):
            for i in range(len(ws) - n + 1):
                if 100 * a >= 80 * good[lang, ws[i : i + n]]:
                    inside.add((lang, ws[i : i + n]))
    scored = {}
    for (lang, ws), a in good.items():
        if (lang, ws) not in inside:
            cuts = [(2_000_000 * a // (f[lang, ws[:k]] + f[lang, ws[k:]]), k, f[lang, ws[:k]], f[lang, ws[k:]]) for k in range(1, len(ws))]
            score, _, left, right = min(cuts)
            scored.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), left, right))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, f[lang, ()], -s)
        for lang, found in scored.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:first])
    )


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_query_against_brute_force(spark):
    want = brute([(d["text"], d["lang"]) for d in documents()])
    assert len(want) >= 50
    assert rows_of(QUERIES["op13_phrase_collocations"](spark, SF_DIR)) == want


@pytest.mark.parametrize("bits", [4, 16])
def test_any_size_of_the_filter(spark, bits):
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["a", "B", "b", "c\x01", "c", "é", "x.", ",", "d!e", "\t", "\n"], size=60)) for _ in range(80)]
    rows = [(t, ["en", "fr", None][i % 3]) for i, t in enumerate(texts)] + [("Same words here again", "en")] * 40
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    for least in (1, 3):
        cfg = co.Settings(least=least, bits=bits)
        assert rows_of(co.top_phrases(df, 50, cfg)) == brute(rows, least, 50)


def test_odd_rows(spark):
    rows = [(r[1], r[2]) for r in odd_rows()]
    cfg = co.Settings(least=2, bits=12)
    assert rows_of(co.top_phrases(odd_docs(spark), 2000, cfg)) == brute(rows, 2)
    assert co.phrases(no_docs(spark), cfg).collect() == []


def test_counts_past_64_bits(spark):
    big = 2**62
    counts = spark.createDataFrame([("en", "", big), ("en", "a", big), ("en", "b", big - 1), ("en", "a b", big - 2)], "lang string, run string, f bigint")
    made, co.count_runs = co.count_runs, lambda *args: counts
    try:
        got = rows_of(co.top_phrases(no_docs(spark), 5))
    finally:
        co.count_runs = made
    assert got == [("en", 1, "a b", big - 2, big, big - 1, big, 2_000_000 * (big - 2) // (2 * big - 1))]
