"""Lenient casts: text that is not a number becomes zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(c: Column) -> Column:
    return F.coalesce(F.trim(c).try_cast("double"), F.lit(0.0))


def to_int(c: Column) -> Column:
    """Numbers with a fraction are truncated, as a parse through double does."""
    return F.coalesce(F.trim(c).try_cast("double").try_cast("int"), F.lit(0))
