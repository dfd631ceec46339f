"""Personal data: identifiers in plain sight, and those behind disguises, with their places in the source.

A text goes through two transducers. The first turns look-alike characters (full-width
forms, other digits, Cyrillic and Greek letters, odd dots and dashes) into ASCII and drops
invisible ones. The second writes spelled digits as digits and at/dot disguises as signs.
Both keep, for every character they write, the source characters it stands for, so an
identifier found in the normalised text is mapped back to a span of the source.

All patterns are matched by runs of their own characters, each looked at once, so that a
text of one hundred thousand digits or ``a@a@a@`` costs no more than any other.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SPANS = "struct<base:array<struct<kind:int,begin:int,end:int>>,added:array<struct<kind:int,begin:int,end:int>>>"

Span = tuple[int, int, int]  # begin, end, index of the kind

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def passes_luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL_SIGNS:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        free = found.end() if found else at + 1
        if found:
            yield begin, free
        at = text.find("@", free)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for chain in _DIGIT_CHAIN.finditer(text) if "." in text else ():
        parts = chain.group().split(".")
        at = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in four):
                yield at, end
            at = end + 1


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 14:
            digits = _NOT_DIGIT.sub("", found.group())
            if 14 <= len(digits) <= 19 and passes_luhn(digits):
                yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", found.group())) <= 15:
                yield found.span()


_FINDERS = (_emails, _addresses, _cards, _phones)


def identifiers(text: str) -> list[Span]:
    """All identifiers in plain sight, by their begin and then by kind; spans of one kind do not overlap."""
    return sorted(
        ((begin, end, kind) for kind, find in enumerate(_FINDERS) for begin, end in find(text)), key=lambda s: (s[0], s[2])
    )


# --- first transducer: look-alikes -----------------------------------------------------------------------------

#: Letters of other scripts that look like ASCII letters, and the signs that compatibility
#: normalisation does not turn into ASCII.
_LOOK_ALIKES = dict(
    zip(
        "АВЕЗКМНОРСТУХаеорсухіјѕԁһӏԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧοανѵɡıƖ‐‑‒–—−·∙⋅。․⁎",
        "ABE3KMHOPCTYXaeopcyxijsdhlqwABEZHIKMNOPTYXoavvgil------.....*",
        strict=True,
    )
)
_INVISIBLE = "­​‌‍⁠﻿"
#: A sign outside ASCII that may stand for an ASCII one: the above, and the blocks of compatibility forms and digits.
_SUSPECT = re.compile(
    "[" + re.escape("".join(_LOOK_ALIKES) + _INVISIBLE) + " ²³¹٠-٩۰-۹०-९"
    "০-৯ -  ⁰-₉℀-⅏①-⓿　﹐-﹫！-～\U0001d400-\U0001d7ff]"
)


def _ascii_for(sign: str) -> str:
    """The ASCII sign that a character looks like; empty if it is invisible, itself if there is none."""
    if sign in _INVISIBLE:
        return ""
    if sign in _LOOK_ALIKES:
        return _LOOK_ALIKES[sign]
    plain = unicodedata.normalize("NFKC", sign)
    if len(plain) == 1 and not plain.isascii():
        digit = unicodedata.digit(plain, None)
        plain = sign if digit is None else str(digit)
    return plain if len(plain) == 1 else sign


class Mapped(NamedTuple):
    """A normalised text with its pieces: where each begins in it, in the source, and whether it is a copy."""

    text: str
    begins: list[int]
    sources: list[tuple[int, int, bool]]

    def source(self, begin: int, end: int) -> tuple[int, int, bool]:
        """The source span of a span, and whether anything in it was rewritten."""
        first, last = bisect_right(self.begins, begin) - 1, bisect_right(self.begins, end - 1) - 1
        low, low_end, low_copy = self.sources[first]
        high, high_end, high_copy = self.sources[last]
        pieces = self.sources[first : last + 1]
        changed = any(not copy for _, _, copy in pieces) or any(a[1] != b[0] for a, b in zip(pieces, pieces[1:]))
        return (
            low + (begin - self.begins[first]) if low_copy else low,
            high + (end - self.begins[last]) if high_copy else high_end,
            changed,
        )


def rewrite(text: str, changes: Iterable[tuple[int, int, str]]) -> Mapped:
    """The text with the spans of ``changes`` (ordered, apart) replaced."""
    out, begins, sources, at, size = [], [], [], 0, 0

    def put(piece: str, begin: int, end: int, copy: bool) -> None:
        nonlocal size
        if piece:
            out.append(piece)
            begins.append(size)
            sources.append((begin, end, copy))
            size += len(piece)

    for begin, end, new in changes:
        put(text[at:begin], at, begin, True)
        put(new, begin, end, False)
        at = end
    put(text[at:], at, len(text), True)
    return Mapped("".join(out), begins, sources)


def _glyph_changes(text: str) -> Iterator[tuple[int, int, str]]:
    for found in _SUSPECT.finditer(text):
        plain = _ascii_for(found.group())
        if plain != found.group():
            yield found.start(), found.end(), plain


# --- second transducer: spelled digits, at and dot -------------------------------------------------------------

#: Digit names in English, German, French and Spanish.
_DIGIT_NAMES = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "oh": "0", "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_LEAST_NAMES = 3
_NAME = "|".join(sorted(_DIGIT_NAMES, key=len, reverse=True))
_DOT_WORD = r"(?:dot|punkt|punto|point)"
_GAP = rf"(?:\s*[-,/()]\s*|\s+(?:(?:dash|hyphen|{_DOT_WORD})\s+)?|\s*[(\[{{<]\s*(?:\.|{_DOT_WORD})\s*[)\]}}>]\s*|\.)"
#: A run of digit names and digits, maybe after a plus.
_SPELLED = re.compile(rf"(?<!\w)(?:plus\s+|\+\s*)?(?:(?:{_NAME})(?!\w)|[0-9]+)(?:{_GAP}(?:(?:{_NAME})(?!\w)|[0-9]+))+")
_SPELLED_PART = re.compile(rf"(?P<plus>plus\s+|\+\s*)|(?P<name>{_NAME})|(?P<digits>[0-9]+)|(?P<dot>\s*[(\[{{<]\s*(?:\.|{_DOT_WORD})\s*[)\]}}>]\s*|\s+{_DOT_WORD}\s+)|(?P<gap>\s+(?:(?:dash|hyphen)\s+)?|\s*[-,/()]\s*)|.", re.S)

_AT = re.compile(
    r"[(\[{<]\s{0,8}(?:at|@|arroba)\s{0,8}[)\]}>]|(?<=\s)(?:at|arroba|@)(?=\s)|(?<=[a-z0-9])[_*]{1,3}at[_*]{1,3}(?=[a-z0-9])"
    r"|(?<=[a-z0-9._%+-])@(?=[a-z0-9-])"
)
#: Top domains behind which a dot between blanks counts as a disguise; elsewhere it ends a sentence.
_TOP = r"(?:com|net|org|edu|gov|info|io|de|fr|es|uk|eu)"
_SPACED_DOT = re.compile(rf"\s{{1,8}}\.\s{{1,8}}(?=(?:[a-z0-9-]{{1,63}}\s{{1,8}}\.\s{{1,8}})?{_TOP}(?![\w-]))")
_DOT = re.compile(rf"\s*[(\[{{<]\s*(?:\.|{_DOT_WORD})\s*[)\]}}>]\s*|\s+{_DOT_WORD}\s+|(?<=[a-z0-9])[_*]{{1,3}}{_DOT_WORD}[_*]{{1,3}}(?=[a-z0-9])")
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_DOT_BEFORE = re.compile(rf"(?:\s*[(\[{{<]\s*(?:\.|{_DOT_WORD})\s*[)\]}}>]|\s{_DOT_WORD})\s*\Z")
_SPACED_ADDRESS = re.compile(r"(?<![\w.])[0-9]{1,3}(?:\s{1,8}\.\s{1,8}[0-9]{1,3}){3}(?!\w)")
_BLANK_DOT = re.compile(r"\s{1,8}\.\s{1,8}")
_LONE_DOT = re.compile(r"\s\.\s")
_NUMBER_DOT = re.compile(rf"(?<=[0-9])(?:\s*[(\[{{<]\s*(?:\.|{_DOT_WORD})\s*[)\]}}>]\s*|\s+{_DOT_WORD}\s+)(?=[0-9])")


def _spelled_changes(low: str) -> Iterator[tuple[int, int, str]]:
    """Digit names in runs with at least three of them, and what stands between the digits of such runs.

    With one or two names a run counts if, written with digits, a finder takes a name in it for part of a number.
    """
    for run in _SPELLED.finditer(low):
        parts = [(m.lastgroup, m.start() + run.start(), m.end() + run.start(), m.group()) for m in _SPELLED_PART.finditer(run.group())]
        n_names = sum(kind == "name" for kind, *_ in parts)
        if n_names < _LEAST_NAMES:
            if n_names:
                yield from _few_names(run, parts)
            continue
        for kind, begin, end, word in parts:
            if kind == "name":
                yield begin, end, _DIGIT_NAMES[word]
            elif kind == "plus":
                yield begin, end, "+"
            elif kind == "dot":
                yield begin, end, "."
            elif kind == "gap":
                yield begin, end, ""


def _few_names(run: re.Match[str], parts: list[tuple[str | None, int, int, str]]) -> list[tuple[int, int, str]]:
    """The changes of a run with few digit names; none unless an address, card or phone has one of the names in it."""
    changes = []
    for kind, begin, end, word in parts:
        if kind == "name":
            changes.append((begin, end, _DIGIT_NAMES[word]))
        elif kind == "plus":
            changes.append((begin, end, "+"))
        elif kind == "dot":
            changes.append((begin, end, "."))
        elif kind == "gap" and not word.isspace() and any(c.isalpha() for c in word):
            changes.append((begin, end, "-"))
    written = rewrite(run.group(), [(b - run.start(), e - run.start(), new) for b, e, new in changes])
    names = [(b - run.start(), e - run.start()) for kind, b, e, _ in parts if kind == "name"]
    for find_kind in _FINDERS[1:]:
        for begin, end in find_kind(written.text):
            begin, end, _ = written.source(begin, end)
            if any(begin <= b and e <= end for b, e in names):
                return changes
    return []


def _at_changes(text: str, low: str) -> Iterator[tuple[int, int, str]]:
    """At and dot disguises of one address: a local part, an at, a label, and at least one dot with a label.

    A bare " at " counts only with a disguised dot in the domain, for it is an ordinary word. An @ between word
    characters is no disguise: it counts with a disguised dot on either side.
    """
    free = 0
    for at in _AT.finditer(low):
        sign, at_begin, end, dots = at.group(), at.start(), at.end(), []
        while at_begin > free and low[at_begin - 1].isspace():
            at_begin -= 1
        while end < len(low) and low[end].isspace():
            end += 1
        at_end = end
        label = _LABEL.match(text, end)
        while label:
            end = label.end()
            dot = _DOT.match(low, end) or _SPACED_DOT.match(low, end)
            if dot:
                label = _LABEL.match(text, dot.end())
                if label:
                    dots.append((dot.start(), dot.end(), "."))
            else:
                label = _LABEL.match(text, end + 1) if text[end : end + 1] == "." else None
                if label:
                    dots.append((end, end + 1, ""))
        hidden = [d for d in dots if d[2]]
        in_sight = sign == "@" and at_begin == at.start()
        if not dots or at_begin < free or (sign in ("at", "arroba") and not hidden):
            continue
        begin, before = at_begin, []
        while True:
            word = begin
            while word > free and text[word - 1] in _LOCAL_SIGNS:
                word -= 1
            if word == begin:
                break
            begin = word
            dot = _DOT_BEFORE.search(low, max(free, begin - 16), begin)
            if not dot or dot.start() <= free or text[dot.start() - 1] not in _LOCAL_SIGNS:
                break
            before.append((dot.start(), begin, "."))
            begin = dot.start()
        if begin < at_begin and (hidden or before or not in_sight):
            yield from reversed(before)
            if not in_sight:
                yield at_begin, at_end, "@"
            yield from hidden
            free = end


def _apart(changes: Iterable[tuple[int, int, str]]) -> Iterator[tuple[int, int, str]]:
    free = 0
    for begin, end, new in sorted(changes):
        if begin >= free:
            yield begin, end, new
            free = end


_LONG_NAMES = [n for n in _DIGIT_NAMES if n != "oh"]
_NAMES_SEEN = (*sorted({n for n in _LONG_NAMES if not any(o in n and o != n for o in _LONG_NAMES)}), " oh", "-oh", "oh ", "oh-")
_DOTS_SEEN = ("dot", "punkt", "punto", "point", "[.]", "(.)", "{.}", "<.>")


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Identifiers that show only in the normalised text, as spans of the source, ordered as ``identifiers``.

    A span is reported if something in it was rewritten and no span of its kind in ``base`` holds all of it.
    """
    first = rewrite(text, _glyph_changes(text)) if not text.isascii() and _SUSPECT.search(text) else None
    plain = first.text if first else text
    low = plain.lower()
    if len(low) != len(plain):  # a few capitals lower to two characters
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in plain)
    changes: list[tuple[int, int, str]] = []
    if any(name in low for name in _NAMES_SEEN):
        changes += _spelled_changes(low)
    dots, spaced = any(x in low for x in _DOTS_SEEN), _LONE_DOT.search(low) is not None
    if dots or spaced or re.search(r"[(\[{<]\s*(?:at|@|arroba)\s*[)\]}>]|[_*]at[_*]|\s@\s", low):
        changes += _at_changes(plain, low)
    if dots:
        changes += [(m.start(), m.end(), ".") for m in _NUMBER_DOT.finditer(low)]
    if spaced:
        changes += [
            (a.start() + m.start(), a.start() + m.end(), ".") for a in _SPACED_ADDRESS.finditer(low) for m in _BLANK_DOT.finditer(a.group())
        ]
    if not first and not changes:
        return []
    second = rewrite(plain, _apart(changes))
    out = []
    for begin, end, kind in identifiers(second.text):
        begin, end, changed = second.source(begin, end)
        if first:
            begin, end, glyphs = first.source(begin, end)
            changed = changed or glyphs
        if changed and not any(k == kind and b <= begin and end <= e for b, e, k in base):
            out.append((begin, end, kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Spans in plain sight, and the spans behind disguises, in code points of the source."""
    base = identifiers(text)
    return base, disguised(text, base)


def text_spans(text: str | Column) -> Column:
    """One struct ``SPANS`` per row; ``kind`` is an index of ``KINDS``, ends are exclusive."""

    @F.arrow_udf(SPANS)
    def spans(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())]))

        def rows(found: list[Span]) -> list[dict]:
            return [{"kind": k, "begin": b, "end": e} for b, e, k in found]

        both = [find(x.as_py() or "") for x in texts]
        return pa.StructArray.from_arrays(
            [pa.array([rows(b) for b, _ in both], type=kind), pa.array([rows(a) for _, a in both], type=kind)], names=["base", "added"]
        )

    return spans(text)


def all_spans(found: Column) -> Column:
    """Base and added spans in one array, by begin and then by kind."""
    key = lambda s: F.struct(s["begin"].alias("begin"), s["kind"].alias("kind"), s["end"].alias("end"))
    return F.array_sort(F.concat(F.transform(found["base"], key), F.transform(found["added"], key)))


def personal_data(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and a struct ``found`` of ``SPANS``.

    A narrow step: every text is looked at whole and by itself, nothing is shuffled. Null and empty texts
    have no spans; ids may be null or repeat; other columns are not read.
    """
    return docs.select(F.col(id_column), text_spans(F.col(text)).alias("found"))


def redact(text: str, spans: Iterable[Span]) -> str:
    """The text with each span replaced by its kind in brackets; spans that overlap become one, named by the first."""
    out, at, open_end = [], 0, -1
    for begin, end, kind in sorted(spans, key=lambda s: (s[0], s[2])):
        if begin < open_end:
            open_end = max(open_end, end)
            at = open_end
            continue
        out += [text[at:begin], f"[{KINDS[kind]}]"]
        at = open_end = end
    return "".join([*out, text[at:]])


def redacted(text: str | Column) -> Column:
    """Each text without its personal data; a null text stays null."""

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        def one(x: str | None) -> str | None:
            return None if x is None else redact(x, sum(find(x), []))

        return pa.array([one(x.as_py()) for x in texts], type=pa.string())

    return clean(text)
