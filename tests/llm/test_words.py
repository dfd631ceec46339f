import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from larkspur.llm.words import chain, find_words, hash_words, shingle_hashes, slices
from tests.llm.frames import odd_rows, words

TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="aAbB \t\n\x0b\x1fé中 ", max_size=12)), max_size=8)


def found(texts, slice_bytes):
    out = {}
    for s in slices(pa.array(texts, type=pa.string()), slice_bytes):
        w = find_words(s)
        raw = s.data.tobytes()
        for i in range(s.rows):
            own = range(w.first[i], w.first[i + 1])
            out[s.first_row + i] = [raw[w.begins[k] : w.ends[k]].decode() for k in own]
    return out


@given(TEXT, st.integers(1, 20))
@settings(deadline=None, max_examples=200)
def test_words_are_those_of_the_pattern(texts, slice_bytes):
    assert found(texts, slice_bytes) == {i: words(t, lower=False) for i, t in enumerate(texts)}


def test_equal_words_have_equal_hashes_and_others_differ():
    texts = [t for _, t, *_ in odd_rows()] + ["a" * 5000, "A" * 5000, "a" * 5001, "a\x00", "a"]
    seen = {}
    for s in slices(pa.array(texts, type=pa.string()), 1000):
        w = find_words(s)
        raw = s.data.tobytes()
        for k, h in enumerate(hash_words(s, w).tolist()):
            word = words(raw[w.begins[k] : w.ends[k]].decode())[0]
            assert seen.setdefault(h, word) == word
    assert len(seen) == len(set(seen.values()))


def test_a_short_text_is_one_run():
    h = np.arange(5, dtype=np.uint64)
    assert len(shingle_hashes(h, 3)) == 3
    assert shingle_hashes(h[:2], 3).tolist() == chain(h[:1], h[1:2]).tolist()
    assert not len(shingle_hashes(h[:0], 3))
