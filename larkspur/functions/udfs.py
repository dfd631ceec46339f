"""Python functions for SQL, each equal to a built-in column expression.

The expressions in ``text`` and ``web`` stay inside the JVM and are what the queries
use; the Python forms exist for callers that need a registered SQL function.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions import web

_MALE, _FEMALE = {"m", "male", "man"}, {"f", "female", "woman"}


def gender_of(text):
    word = (text or "").lower()
    if word in _MALE:
        return "Male"
    return "Female" if word in _FEMALE else "Unknown"


def employees_of(text):
    """(low, high) of a head-count text."""
    if text is None:
        return None, None
    number = re.search(r"\d+", text)
    if "More than" in text and number:
        return int(number.group()) + 1, None
    ends = re.fullmatch(r"\s*(\d+)\s*(?:-\s*(\d+)\s*)?", text, re.ASCII)
    if not ends:
        return None, None
    return int(ends[1]), int(ends[2] or ends[1])


_RANGE = T.StructType([T.StructField("low", T.IntegerType()), T.StructField("high", T.IntegerType())])

gender_udf = F.udf(gender_of, T.StringType(), useArrow=True)
employees_udf = F.udf(employees_of, _RANGE, useArrow=True)


def register_gender(spark: SparkSession, name: str = "parse_gender_udf") -> str:
    """Make the gender function callable from SQL; returns its name."""
    spark.udf.register(name, gender_udf)
    return name


_BY_NAME: dict[str, Callable[[Column], Column]] = {
    "extract_browser": web.browser,
    "extract_os": web.operating_system,
    "extract_referrer_domain": web.authority,
}


def column_function(name: str) -> Callable[[Column], Column]:
    """A column function by name; an unknown name raises ValueError."""
    if name not in _BY_NAME:
        raise ValueError(f"unknown function: {name}")
    return _BY_NAME[name]
