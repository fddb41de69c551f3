"""What several operators of this package share."""

from __future__ import annotations

import sys
import types
import zlib
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def word_count(text: Column) -> Column:
    """Number of words as a long, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def crc_mod(doc_id: int | None, n: int) -> int:
    """The same on a Python value."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


T = TypeVar("T")


def per_worker(key: tuple, make: Callable[[], T]) -> T:
    """What ``make`` gives, once per Python worker: tasks that a worker runs later find it again."""
    kept = sys.modules.setdefault("tastegraph_worker", types.ModuleType("tastegraph_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
