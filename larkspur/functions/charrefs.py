"""HTML character references as column expressions: no Python worker, longest match as browsers do it.

No reference runs over a second ``&``, so a text is cut there and the front of each part is looked at alone. The names
come from the standard library's table; in the plan they are a constant array of small maps, dealt by
the CRC of the name, so that a name is compared with a few others and not with all of them.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Maps that the names are dealt to.
_MAPS = 64
#: Names that also count without a semicolon, longest first.
_BARE = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
_LONGEST = max(map(len, html5))
_UNKNOWN = "�"


def _in_windows_1252(code: int) -> str:
    try:
        return bytes([code]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(code)


# Numbers of C1 control characters mean the characters that Windows has there.
_C1 = "".join(map(chr, range(0x80, 0xA0)))
_C1_MEANS = "".join(map(_in_windows_1252, range(0x80, 0xA0)))


def _map(names: Iterable[str]) -> Column:
    """A constant map from names to characters, one text in the plan until the optimizer folds it."""
    return F.str_to_map(F.lit("\x01".join(f"{name}\x02{html5[name]}" for name in names)), F.lit("\x01"), F.lit("\x02"))


def _dealt(names: Iterable[str]) -> list[list[str]]:
    maps: list[list[str]] = [[] for _ in range(_MAPS)]
    for name in names:
        maps[zlib.crc32(name.encode()) % _MAPS].append(name)
    return maps


def _character(number: Column) -> Column:
    """The character of a code point below 0x110000."""
    # a byte order mark is taken off by the decoder; the one put in front keeps another behind it
    character = F.decode(F.unhex(F.concat(F.lit("0000feff"), F.lpad(F.hex(number), 8, "0"))), "UTF-32")
    nothing = (
        number.between(0x1, 0x8) | (number == 0xB) | number.between(0xE, 0x1F) | (number == 0x7F)
        | number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(0xFFFE) == 0xFFFE)
    )
    unknown = (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
    return F.when(unknown, _UNKNOWN).when(nothing, "").otherwise(F.translate(character, _C1, _C1_MEANS))


def _numbered(digits: Column, base: int, most: int) -> Column:
    """The character of a number; one of more than ``most`` digits without leading zeros is too large."""
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    return F.when(F.length(short) > most, _UNKNOWN).otherwise(_character(F.conv(F.substr(short, F.lit(1), F.lit(most)), base, 10).cast("bigint")))


def decode_references(text: Column) -> Column:
    """The text with its character references decoded, the same as ``html.unescape``.

    What is no reference stays as it is; a null text stays null.
    """
    names = F.array(*map(_map, _dealt(html5)))
    bare_names = _map(_BARE)

    def named(name: Column) -> Column:
        return F.element_at(F.get(names, (F.crc32(name) % _MAPS).cast("int")), name)

    def behind(part: Column, reference: Column) -> Column:
        return F.substr(part, F.length(reference) + 1)

    def one(part: Column) -> Column:
        closed = F.regexp_extract(part, rf"^[A-Za-z0-9]{{2,{_LONGEST}}};", 0)
        bare = F.regexp_extract(part, f"^(?:{'|'.join(map(re.escape, _BARE))})", 0)
        decimal, hexadecimal = r"^#([0-9]+);?", r"^#[xX]([0-9a-fA-F]+);?"
        return (
            F.when(part.startswith("#"), F.when(
                part.rlike(decimal), F.concat(_numbered(F.regexp_extract(part, decimal, 1), 10, 7), F.regexp_replace(part, decimal, ""))
            ).when(
                part.rlike(hexadecimal), F.concat(_numbered(F.regexp_extract(part, hexadecimal, 1), 16, 6), F.regexp_replace(part, hexadecimal, ""))
            ).otherwise(F.concat(F.lit("&"), part)))
            .otherwise(F.coalesce(
                F.concat(named(closed), behind(part, closed)), F.concat(F.element_at(bare_names, bare), behind(part, bare)),
                F.concat(F.lit("&"), part),
            ))
        )

    parts = F.split(text, "&")
    decoded = F.concat(F.get(parts, 0), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), one), ""))
    return F.when(text.contains("&"), decoded).otherwise(text)
