"""Title, genre and word helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Year pattern of a title (blank needed), the looser one without
# the blank, and the year used when a title has none.
TITLE_YEAR = r".* \(([1-9][0-9][0-9][0-9])\).*"
LOOSE_YEAR = r".*\(([1-9][0-9][0-9][0-9])\).*"
DEFAULT_YEAR = 1994


def title_year(title: Column, default: int = DEFAULT_YEAR) -> Column:
    """Last ``(yyyy)`` that follows a blank, else ``default``."""
    return F.coalesce(F.regexp_extract(title, TITLE_YEAR, 1).try_cast("int"), F.lit(default))


def loose_title_year(title: Column) -> Column:
    """Last ``(yyyy)`` with or without a blank, NULL when there is none."""
    return F.regexp_extract(title, LOOSE_YEAR, 1).try_cast("int")


def genre_tokens(genre: Column, limit: int = 10) -> Column:
    return F.slice(F.split(genre, r"\|"), 1, limit)


def word_count(text: Column) -> Column:
    """Words separated by single blanks; trailing blanks do not count."""
    return F.size(F.split(F.rtrim(text), " "))


def literal_pattern(sep: str) -> str:
    """Regex that matches ``sep`` literally; one plain character splits without a regex."""
    return "".join(f"\\{c}" if c in r".$|()[{^?*+\\" else c for c in sep)
