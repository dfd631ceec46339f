import re
import zlib

import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from larkspur.llm import quality_classifier as qc
from larkspur.llm import quality_rules as qr
from larkspur.llm.queries import QUERIES
from tests.llm.frames import SF_DIR, documents, no_docs, odd_docs, odd_rows, words


def base_measures(text):
    w = words(text, lower=False)
    lines = [x for x in (text or "").split("\n") if words(x)]
    runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    again = {i + k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(3)} if len(w) < 3000 else None
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), again if again is None else len(again)


def test_measures_against_brute_force(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op10_compression_bands"](spark, SF_DIR).collect()}
    docs = documents()
    assert len(rows) == len(docs)
    for d in docs:
        r, want = rows[d["doc_id"]], base_measures(d["text"])
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == want or want[4] is None and got[:4] == want[:4]
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        raw = d["text"].encode()
        ratio = len(zstandard.ZstdCompressor(level=3, write_checksum=False).compress(raw)) / len(raw)
        assert r["ratio"] == pytest.approx(ratio)
        band = next(b for b in qr.BANDS if b.below is None or len(raw) < b.below)
        chunks = [len(zstandard.ZstdCompressor(level=3).compress(raw[i : i + 4096])) / 4096 for i in range(0, len(raw) - 4095, 4096)]
        bad = sum(not qr.CHUNK_BAND.low <= x <= qr.CHUNK_BAND.high for x in chunks)
        assert r["kept"] == (not r["base_failed"] and band.low <= ratio <= band.high and bad <= 0.25 * len(chunks))


def test_bands_on_odd_rows(spark):
    rows = qr.compression_bands(odd_docs(spark)).collect()
    assert len(rows) == len(odd_rows())
    by_text = {r["measures"]["n_bytes"]: r for r in rows}
    assert by_text[0]["measures"]["ratio"] == 1.0 and by_text[0]["in_bands"]
    assert not by_text[70_000]["in_bands"] and not by_text[120_000]["in_bands"]
    assert qr.compression_bands(no_docs(spark)).count() == 0


def test_random_bytes_fail_and_a_bad_stretch_is_found(spark):
    import random

    rng = random.Random(3)
    noise = "".join(chr(rng.randrange(33, 127)) for _ in range(12_000))
    prose = " ".join(rng.choice(["river", "stone", "bright", "walked", "toward", "morning", "quiet", "letters"]) + str(rng.randrange(99)) for _ in range(2000))
    df = spark.createDataFrame([(1, noise), (2, prose), (3, prose[:6000] + "spam " * 3000)], "doc_id int, text string")
    assert {r["doc_id"]: r["in_bands"] for r in qr.compression_bands(df).collect()} == {1: False, 2: True, 3: False}


@pytest.mark.parametrize("alphabet", [
    "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "".join(chr(x) for x in range(0x4E00, 0x9FA5)), "".join(chr(x) for x in range(0x430, 0x450)),
])
def test_random_words_of_any_alphabet_fail(spark, alphabet):
    import random

    rng = random.Random(3)
    noise = " ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(3, 10))) for _ in range(1800))
    df = spark.createDataFrame([(1, noise), (2, noise[:6000])], "doc_id int, text string")
    assert [r["in_bands"] for r in qr.compression_bands(df).collect()] == [False, False]


def test_one_chunk_of_noise_breaks_a_text(spark):
    import random

    rng = random.Random(3)
    texts = [d["text"] for d in documents() if len(d["text"]) > 4200 and qr.measure(pa.array([d["text"]])).to_pylist()[0]["n_repeat_words"] < 50]
    prose = " ".join(texts)[:40_000]
    noise = "".join(chr(rng.randrange(33, 127)) for _ in range(4096))
    rows = [(1, prose), (2, prose[:12_288] + noise[:4000]), (3, prose[:8192].encode()[:8192].decode(errors="ignore") + noise * 2 + prose[8192:]), (4, prose[:12_288])]
    found = {r["doc_id"]: r["in_bands"] for r in qr.compression_bands(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert found == {1: True, 2: False, 3: False, 4: True}


def test_a_bad_tail_is_found(spark):
    import random

    rng = random.Random(3)
    noise = "".join(chr(rng.randrange(33, 127)) for _ in range(4095))
    prose = " ".join(rng.choice(["river", "stone", "bright", "walked", "toward", "morning", "quiet", "letters"]) + str(rng.randrange(99)) for _ in range(2000))
    phrase = ("spam and more " * 300)[:4095]
    texts = [(1, prose[:4096] + noise), (2, prose[:4096] + phrase), (3, prose[:8191]), (4, prose[:4096]), (5, prose[:4095])]
    df = spark.createDataFrame(texts, "doc_id int, text string")
    rows = {r["doc_id"]: r for r in qr.compression_bands(df).collect()}
    assert [(rows[i]["measures"]["low_tail"], rows[i]["measures"]["high_tail"]) for i in range(1, 6)] == [(0, 1), (1, 0), (0, 0), (0, 0), (0, 0)]
    assert {i: r["in_bands"] for i, r in rows.items()} == {1: False, 2: False, 3: True, 4: True, 5: True}


def test_classifier_on_held_out_rows(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = QUERIES["op2_quality_classifier"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 50
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.95 * len(held)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_score_is_the_dot_product(spark):
    import numpy as np
    import pyarrow as pa

    from larkspur.llm.words import slices

    cfg = qc.Settings(bits=10)
    rng = np.random.default_rng(0)
    model = qc.Model(rng.normal(size=1 << 10), 0.3, cfg)
    texts = pa.array([t for _, t, *_ in odd_rows()], type=pa.string())
    got = qc.score_texts(texts, model).to_pylist()
    for i, text in enumerate(texts.to_pylist()):
        (s,) = slices(pa.array([text], type=pa.string()))
        index, first = qc.features(s, 10)
        margin = 0.3 + cfg.scale * sum(model.weights[k] for k in index) / len(index)
        assert first.tolist() == [0, len(index)]
        assert got[i] == pytest.approx(1 / (1 + np.exp(-np.clip(margin, -35, 35))), rel=1e-6, abs=1e-12)


def test_classifier_on_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(6, 1), (6, 0), (6, 1), (10, 0), (None, 1), (4, None), (99, 1)], "doc_id bigint, quality int")
    model = qc.fit(docs, labels, settings=qc.Settings(bits=12, shards=2))
    rows = qc.quality_scores(docs, model).collect()
    assert len(rows) == len(odd_rows())
    score = {r["doc_id"]: r["score"] for r in rows}
    assert score[6] > 0.5 > score[10]
    nothing = qc.fit(docs, labels.where(F.lit(False)))
    assert {r["score"] for r in qc.quality_scores(docs, nothing).collect()} == {0.5}
    assert qc.quality_scores(no_docs(spark), model).count() == 0
