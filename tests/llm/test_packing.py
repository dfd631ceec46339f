import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from larkspur.llm import packing
from larkspur.llm.queries import QUERIES, tokenizer_path
from larkspur.llm.words import slices
from tests.llm.frames import SF_DIR, documents, no_docs, odd_docs, odd_rows


def places(counts, capacity):
    bins, seen = {}, {}
    for r in packing.plan(counts, capacity):
        assert r.rank == seen.get(r.length, 0)
        seen[r.length] = r.rank + r.count
        for i in range(r.count):
            bins.setdefault(r.first_bin + i // r.per_bin, []).append((r.offset + i % r.per_bin * r.length, r.length))
    assert seen == {n: c for n, c in counts.items() if c}
    return bins


def check_gapless(bins, capacity):
    for rows in bins.values():
        end = 0
        for offset, length in sorted(rows):
            assert offset == end
            end += length
        assert end <= capacity


def test_plans_hold_every_document_without_gaps():
    rng = random.Random(1)
    for _ in range(400):
        capacity = rng.randint(1, 60)
        counts = {rng.randint(1, capacity): rng.randint(0, 9) for _ in range(rng.randint(0, 20))}
        bins = places(counts, capacity)
        check_gapless(bins, capacity)
        assert all(sum(3 * n > capacity for _, n in rows) <= 2 for rows in bins.values())
        assert len(bins) <= 11 / 9 * -(-sum(n * c for n, c in counts.items()) // capacity) + sum(counts.values()) / 2 + 1


def test_large_items_are_matched_and_small_ones_fill_gaps():
    bins = places({60: 2, 40: 2, 55: 1, 30: 1, 15: 1}, 100)
    assert sorted(sorted(n for _, n in rows) for rows in bins.values()) == [[15, 30, 55], [40, 60], [40, 60]]


@pytest.mark.parametrize("length, want", [(1, [(0, 1)]), (2048, [(0, 2048)]), (2049, [(0, 1), (1, 2049)]), (4096, [(0, 2048), (2048, 4096)])])
def test_only_longer_documents_are_cut(length, want):
    assert packing.pieces(length, 2048) == want


def test_unit_ids_are_those_of_whole_texts():
    rng = random.Random(2)
    parts = [" ", "  ", "\n", " \n", " ", " ", "a", "é", "'s", "12", "!", " x", "中", "<|endoftext|>", "\t", "'", "\x85", "Wörter", " can't", "​", "|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(1500)] + ["", " word" * 2000, "x" * 3000]
    encoder, whole = packing.Encoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    for s in slices(pa.array(texts), 4000):
        ids, first = encoder.encode(s)
        for i in range(s.rows):
            assert ids[first[i] : first[i + 1]].tolist() == want[s.first_row + i], texts[s.first_row + i]


def check_rows(rows, texts, capacity=2048):
    whole = Tokenizer.from_file(tokenizer_path())
    bins, by_doc = {}, {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    check_gapless(bins, capacity)
    for doc, text in texts.items():
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        mine = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [(r["start"], r["start"] + r["length"]) for r in mine] == packing.pieces(len(ids), capacity)
        assert [r["ids_crc32"] for r in mine] == [zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in mine]
    return len(bins)


def test_query(spark):
    rows = QUERIES["op4_best_fit_packing"](spark, SF_DIR).collect()
    bins = check_rows(rows, {d["doc_id"]: d["text"] for d in documents()})
    assert bins <= 1.02 * sum(r["length"] for r in rows) / 2048 + 1


def test_odd_rows_and_ids(spark):
    rows = packing.pack(odd_docs(spark), tokenizer_path()).collect()
    ids = [r["doc_id"] for r in rows if r["piece"] == 0]
    assert sorted(ids, key=str) == sorted((r[0] for r in odd_rows()), key=str)
    check_rows(rows, {r[0]: r[1] for r in odd_rows() if r[0] not in (7, 14, None)})
    for r in rows:
        assert len(r["ids"]) == r["length"]
        if r["doc_id"] in (1, 2):
            assert list(r["ids"]) == [0]
    assert packing.pack(no_docs(spark), tokenizer_path()).count() == 0
