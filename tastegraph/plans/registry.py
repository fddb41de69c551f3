"""Named queries and the SQL each of them is checked against."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}
STORED: set[str] = set()


def cte(name: str, body: str, stored: bool = False) -> None:
    """A table expression; ``stored`` ones are computed once, so nothing above moves into their joins."""
    CTES[name] = body.strip()
    if stored:
        STORED.add(name)


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the common table expressions it mentions."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    parts = [f"{n} AS {'MATERIALIZED ' if n in STORED else ''}(\n{b}\n)" for n, b in CTES.items() if n in needed]
    return (f"WITH RECURSIVE {', '.join(parts)}\n{body.strip()}" if parts else body.strip())


def query(name: str, sql: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, root: str) -> DataFrame:
            tune(spark)
            return fn(spark, root.rstrip("/"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def oracles() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in ORACLES.items()}
