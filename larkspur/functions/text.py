"""Text cleaning as column expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.charrefs import decode_references

# Letters outside ASCII whose decomposed form starts with an ASCII letter, found by rule.
_FOLDED = [
    (chr(code), unicodedata.normalize("NFD", chr(code))[0])
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]
    if unicodedata.normalize("NFD", chr(code))[0].isascii()
]
_STROKED = [("đ", "d"), ("Đ", "D"), ("ø", "o"), ("Ø", "O"), ("ł", "l"), ("Ł", "L"), ("ı", "i")]
_MARKS = [chr(code) for code in range(0x300, 0x370)]
_FROM = "".join(a for a, _ in _FOLDED + _STROKED) + "".join(_MARKS)
_TO = "".join(b for _, b in _FOLDED + _STROKED)


def fold_accents(text: Column) -> Column:
    """Lower-case text with accents removed; combining marks are dropped."""
    folded = F.translate(F.lower(text), _FROM, _TO)
    for letter, spelling in (("ß", "ss"), ("æ", "ae"), ("œ", "oe")):
        folded = F.replace(folded, F.lit(letter), F.lit(spelling))
    return folded


def first_category(text: Column, categories: Mapping[str, Sequence[str]], default: str) -> Column:
    """The first category, in mapping order, one of whose keywords occurs in the folded text."""
    folded = fold_accents(text)
    tests = [
        (name, folded.rlike("|".join(re.escape(k) for k in words)))
        for name, words in categories.items()
    ]
    out = F.when(tests[0][1], tests[0][0])
    for name, test in tests[1:]:
        out = out.when(test, name)
    return out.otherwise(default)


# Job categories and their keywords, in the order in which they are tried.
JOB_CATEGORIES = {
    "IT": [
        "software", "it", "programmer", "developer", "lap trinh", "tester", "fullstack", "aws",
        "android", "java", "javascript", "web", "system", "linux", "may tinh", "server", "cntt",
        "he thong", "dotnet",
    ],
    "Data Science": [
        "data", "database", "machine learning", "khoa hoc du lieu", "hoc may", "analyst",
        "thong tin", "ai",
    ],
    "Designer": ["designer", "thiet ke", "artist", "animation", "ux/ui"],
    "Sales": ["sales", "kinh doanh"],
    "Human Resources": ["hr", "nhan su"],
}


def job_category(title: Column) -> Column:
    return first_category(title, JOB_CATEGORIES, "Other")


def gender_label(text: Column) -> Column:
    """Male, Female or Unknown; NULL counts as Unknown."""
    word = F.lower(text)
    return (
        F.when(word.isin("m", "male", "man"), "Male")
        .when(word.isin("f", "female", "woman"), "Female")
        .otherwise("Unknown")
    )


def head_count(text: Column) -> Column:
    """``struct<low:int, high:int>`` from '500-1000', 'More than 1000' or '5'.

    An open range starts one above its number and has no upper end; other text, such as
    '1-5-9' or '-5', gives NULLs.
    """
    bounds = r"^\s*(\d+)\s*(?:-\s*(\d+)\s*)?$"

    def whole(part: Column) -> Column:
        return F.trim(part).try_cast("int")

    first, last = F.regexp_extract(text, bounds, 1), F.regexp_extract(text, bounds, 2)
    low = F.when(text.contains("More than"), whole(F.regexp_extract(text, r"\d+", 0)) + 1).otherwise(whole(first))
    high = F.when(~text.contains("More than"), whole(F.when(last == "", first).otherwise(last)))
    return F.struct(low.alias("low"), high.alias("high"))


def height_inches(text: Column) -> Column:
    """Inches from 'feet-inches'."""
    parts = F.split(text, "-")
    return F.get(parts, 0).try_cast("int") * 12 + F.get(parts, 1).try_cast("int")


def region_part(hometown: Column) -> Column:
    """What follows the first comma, or the whole text if there is none; blanks trimmed."""
    parts = F.split(hometown, ",")
    return F.trim(F.when(F.size(parts) == 1, hometown).otherwise(F.get(parts, 1)))


def trim_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strip white space from the named string columns."""
    return df.withColumns({name: F.regexp_replace(name, r"^\s+|\s+$", "") for name in columns})


def join_words(text: Column) -> Column:
    """'caloRie consuMed' -> 'Calorie_Consumed'."""
    return F.array_join(F.split(F.trim(F.initcap(text)), r"\s+"), "_")


def split_tokens(text: Column, separator: str = "|") -> Column:
    """Separated names with blanks made '_', double quotes dropped and empty entries left out."""
    spaced = F.translate(text, ' "', "_")
    return F.filter(F.split(spaced, re.escape(separator)), lambda x: x != "")


def html_text(markup: Column) -> Column:
    """The visible text of a page: comments, scripts, styles and templates out, tags dropped."""
    text = F.regexp_replace(markup, r"(?s)<!--.*?-->", "")
    text = F.regexp_replace(text, r"(?is)<(script|style|template)\b[^>]*>.*?</\1\s*>", "")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    return decode_references(text)


def plain_words(text: Column) -> Column:
    """Lower case, punctuation and runs of dots to blanks, white space collapsed."""
    out = F.lower(text)
    out = F.regexp_replace(out, r"[\r\t\n]", " ")
    out = F.regexp_replace(out, r"\.{2,}", " ")
    out = F.regexp_replace(out, r"""[{};():,."/<>-]""", " ")
    out = F.regexp_replace(out, r"[\s\u00a0]{2,}", " ")
    return F.regexp_replace(out, r"^[\s\u00a0]+|[\s\u00a0]+$", "")


def clean_html(markup: Column) -> Column:
    """HTML to clean lower-case text."""
    return plain_words(html_text(markup))


def element_text(markup: Column, tag: str, css_class: str | None = None) -> Column:
    """Stripped text of the first element with this tag and class, 'fail' if there is none or it is empty."""
    attrs = r"[^>]*" if css_class is None else rf'[^>]*\bclass="(?:[^"]*\s)?{css_class}(?:\s[^"]*)?"[^>]*'
    inner = F.regexp_extract(markup, rf"(?is)<{tag}\b{attrs}>(.*?)</{tag}\s*>", 1)
    text = F.trim(decode_references(F.regexp_replace(inner, r"<[^>]*>", "")))
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("fail"))


def element_attribute(markup: Column, tag: str, attribute: str) -> Column:
    """Value of an attribute of the first such element, NULL if missing."""
    value = F.regexp_extract(markup, rf"""(?is)<{tag}\b[^>]*\s{attribute}=["']([^"']*)["']""", 1)
    return F.nullif(value, F.lit(""))


def markdown_links(text: Column, url_prefix: str) -> Column:
    """``array<struct<label, url>>`` of the [label](url) links whose url starts with the prefix."""
    pattern = r"\[(.*?)\]\((" + re.escape(url_prefix) + r"[^\s]+)"
    labels = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    urls = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    return F.arrays_zip(labels.alias("label"), urls.alias("url"))


def common_prefix(low: Column, high: Column) -> Column:
    """Longest common prefix of two strings, '-1' if they share nothing.

    For a group of strings pass its smallest and largest: what those two share, all share.
    The length is found by halving steps, so long texts are compared about once.
    """
    n = F.least(F.length(low), F.length(high))
    steps = F.lit([1 << i for i in range(30, -1, -1)])

    def grow(size: Column, step: Column) -> Column:
        same = F.substr(low, size + 1, step) == F.substr(high, size + 1, step)
        return F.when((size + step <= n) & same, size + step).otherwise(size)

    size = F.aggregate(steps, F.lit(0), grow)
    return F.when(size == 0, "-1").otherwise(F.substr(low, F.lit(1), size))
