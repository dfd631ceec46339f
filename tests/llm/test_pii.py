import hashlib
import random
import re

import pytest

from larkspur.llm import pii
from larkspur.llm.queries import QUERIES
from tests.llm.frames import SF_DIR, documents, no_docs, odd_docs, odd_rows

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return [int(c) for c in text if c in "0123456789"]


def luhn(ds):
    return sum(d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(reversed(ds))) % 10 == 0


def brute(text):
    out = [(m.start(), m.end(), 0) for m in EMAIL.finditer(text)]
    out += [(m.start(), m.end(), 1) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), m.end(), 2) for m in CARD.finditer(text) if 14 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_plain_spans_are_those_of_the_patterns():
    rng = random.Random(5)
    parts = ["a", "1", "@", ".", "+", "-", " ", "(", "5", "%", "123", "4316522678525456", "a@b.c", "1.2.3.4", "+1 415", "..", "255.", "é"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(24)))
        assert pii.identifiers(text) == brute(text), text


@pytest.mark.parametrize("text, kind, hidden", [
    ("write john (at) example (dot) com today", "email", "john (at) example (dot) com"),
    ("write john dot doe at example dot co dot uk today", "email", "john dot doe at example dot co dot uk"),
    ("write joe_at_example_dot_com", "email", "joe_at_example_dot_com"),
    ("write аdmin＠exаmple．com now", "email", "аdmin＠exаmple．com"),
    ("write ad​min@example.com", "email", "ad​min@example.com"),
    ("call plus one four one five five five five two six seven one ok", "phone", "plus one four one five five five five two six seven one"),
    ("host 192[.]168[.]1[.]10 up", "ip", "192[.]168[.]1[.]10"),
    ("host １０.0.0.１ up", "ip", "１０.0.0.１"),
    ("pay 4316－5226－7852－5456 now", "card", "4316－5226－7852－5456"),
    ("pay four three one six five two two six seven eight five two five four five six", "card",
     "four three one six five two two six seven eight five two five four five six"),
])
def test_disguises_map_back_to_the_source(text, kind, hidden):
    base, added = pii.find(text)
    assert [(pii.KINDS[k], text[b:e]) for b, e, k in added] == [(kind, hidden)]
    assert hidden not in pii.redact(text, base + added)


@pytest.mark.parametrize("text", [
    "meet me at noon dot", "we are at home", "one two three", "look at example.com", "x @ y", "un deux trois", "point at the dot",
    "Привет мир", "eins zwei drei vier", "12 (at) 13", "١٢٣",
])
def test_clean_texts_stay_clean(text):
    assert pii.find(text) == ([], [])


@pytest.mark.parametrize("unit", ["1", "a", "a@", "_", " ", "[ ", "one ", "1.", "+1 ", "( ", "@ ", "at ", "​", "dot "])
def test_long_runs_take_linear_time(unit):
    import time

    start = time.perf_counter()
    pii.find(unit * (200_000 // len(unit)))
    assert time.perf_counter() - start < 20


def test_query_against_brute_force(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op3_pii_deobfuscation"](spark, SF_DIR).collect()}
    for d in documents():
        base, r = brute(d["text"]), rows[d["doc_id"]]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s[2] == k for s in base) for k in range(4)]
        told = [f"{pii.KINDS[k]}:{b}:{e}" for b, e, k in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert set(told) <= set(r["spans"].split(",")) or not told


def test_odd_rows(spark):
    rows = pii.personal_data(odd_docs(spark)).collect()
    assert len(rows) == len(odd_rows())
    found = {r["doc_id"]: r["found"] for r in rows}
    assert not found[1]["base"] and not found[2]["added"] and [s["kind"] for s in found[13]["base"]] == [0, 3]
    assert pii.personal_data(no_docs(spark)).count() == 0
    clean = odd_docs(spark).select("doc_id", pii.redacted("text").alias("t")).collect()
    assert {r["doc_id"]: r["t"] for r in clean}[13] == "mail [email] or [phone]"
    assert {r["doc_id"]: r["t"] for r in clean}[1] is None


@pytest.mark.parametrize("text, kind, hidden", [
    ("write john@example[.]com today", "email", "john@example[.]com"),
    ("write john@example (dot) com today", "email", "john@example (dot) com"),
    ("write john@example dot com", "email", "john@example dot com"),
    ("write john (dot) doe at example (dot) com today", "email", "john (dot) doe at example (dot) com"),
    ("write john @ example.com today", "email", "john @ example.com"),
    ("call +1 415 555 01 two three", "phone", "+1 415 555 01 two three"),
    ("call plus 1 415 555 012 three now", "phone", "plus 1 415 555 012 three"),
    ("host 192.168.one.two up", "ip", "192.168.one.two"),
    ("host 192 dot 168 dot one dot 7 up", "ip", "192 dot 168 dot one dot 7"),
    ("pay 4316 5226 7852 545 six, 20 times", "card", "4316 5226 7852 545 six"),
    ("write joe @ example . com today", "email", "joe @ example . com"),
    ("write joe at example . com today", "email", "joe at example . com"),
    ("write joe@example . com today", "email", "joe@example . com"),
    ("write joe@mail . example . org today", "email", "joe@mail . example . org"),
    ("host 192 . 168 . 1 . 10 up", "ip", "192 . 168 . 1 . 10"),
    ("call plus four-one-five-five-five-five-oh-one-two-three ok", "phone", "plus four-one-five-five-five-five-oh-one-two-three"),
])
def test_partial_disguises(text, kind, hidden):
    base, added = pii.find(text)
    assert (pii.KINDS.index(kind), hidden) in [(k, text[b:e]) for b, e, k in added]
    assert hidden not in pii.redact(text, base + added)


@pytest.mark.parametrize("text", [
    "we met at noon . then we left", "sold @ noon . The rest", "1 . 2 . 3", "oh oh oh no", "see 1 . 2 . 3 . 400", "sold at example.com", "chapter one 1.2.3", "two 2 many", "thanks @example.com", "x @ y", "one 1 of +1 two",
])
def test_partial_disguises_leave_clean_texts(text):
    assert pii.find(text) == ([], [])


@pytest.mark.parametrize("text, visible, whole", [
    ("write joe@mail.exаmple.com now", "joe@mail.ex", "joe@mail.exаmple.com"),
    ("write аdmin@mail.com now", "dmin@mail.com", "аdmin@mail.com"),
    ("write joe@mail.ex​ample.com now", "joe@mail.ex", "joe@mail.ex​ample.com"),
    ("write joe@mail.example[.]com now", "joe@mail.example", "joe@mail.example[.]com"),
    ("write john (dot) doe@example.com now", "doe@example.com", "john (dot) doe@example.com"),
])
def test_a_visible_fragment_does_not_hide_the_whole(text, visible, whole):
    base, added = pii.find(text)
    assert [text[b:e] for b, e, _ in base] == [visible]
    assert [text[b:e] for b, e, _ in added] == [whole]
    assert pii.redact(text, base + added) == "write [email] now"


def test_an_invisible_sign_alone_is_a_disguise():
    text = "pay 4316\u200b522678525456 now"
    assert pii.find(text) == ([], [(4, 21, pii.KINDS.index("card"))])
