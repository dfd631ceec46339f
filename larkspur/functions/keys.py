"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha_key(column: Column) -> Column:
    """SHA-256 of a text; NULL stays NULL."""
    return F.sha2(column.cast("string"), 256)


def sales_key(event_id: Column, product_id: Column) -> Column:
    """SHA-256 of event id and product id. A missing product counts as '', a missing id gives NULL."""
    return F.sha2(F.concat(event_id.cast("string"), F.coalesce(product_id.cast("string"), F.lit(""))), 256)


def fingerprint(*parts: Column) -> Column:
    """64-bit key of the joined text of the parts; NULL if any part is NULL."""
    text = F.concat(*[p.cast("string") for p in parts])
    return F.when(text.isNotNull(), F.xxhash64(text))
