"""Delimited text inputs: ratings, catalogue, behaviour, dictionary, points."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import literal_pattern
from ..functions.vectors import sparse_vector

RATING_TYPES = (("userid", "bigint"), ("itemid", "bigint"), ("rate", "double"), ("ts", "bigint"))


def _typed(parts: Column, types=RATING_TYPES) -> list[Column]:
    return [F.trim(parts[i]).try_cast(t).alias(n) for i, (n, t) in enumerate(types)]


def parse_ratings(lines: DataFrame, sep: str = "::", on_bad: str = "raise") -> DataFrame:
    """Exactly four fields per line.  ``on_bad='drop'`` skips lines that do not parse."""
    parts = F.split("value", literal_pattern(sep), -1)
    rows = lines.select("value", parts.alias("p")).select(
        "value", F.size("p").alias("n"), *[
            F.when(F.size("p") == 4, F.trim(F.get("p", F.lit(i))).try_cast(t)).alias(c)
            for i, (c, t) in enumerate(RATING_TYPES)])
    good = (F.col("n") == 4)
    for name, _ in RATING_TYPES:
        good = good & F.col(name).isNotNull()
    names = [n for n, _ in RATING_TYPES]
    if on_bad == "drop":
        return rows.where(good).select(*names)
    # a filter, because no later choice of columns can take it away
    checked = F.when(good, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("bad rating line: "), "value")).cast("boolean"))
    return rows.where(checked).select(*names)


def read_ratings_text(spark: SparkSession, path: str, sep: str = "::",
                      on_bad: str = "raise") -> DataFrame:
    return parse_ratings(spark.read.text(path), sep, on_bad)


def read_ratings_collapsed(spark: SparkSession, path: str, sep_class: str = ":") -> DataFrame:
    """Trimmed lines; a run of any of the separator characters counts as one."""
    escaped = "".join(c if c.isalnum() else f"\\{c}" for c in sep_class)
    parts = F.split(F.trim("value"), f"[{escaped}]+")
    return spark.read.text(path).select(parts.alias("p")).select(*_typed(F.col("p")))


def read_behaviour_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("userid bigint, itemid bigint, rate double, ts bigint").csv(path)


def read_catalogue(spark: SparkSession, path: str, sep: str = "::") -> DataFrame:
    parts = F.split("value", literal_pattern(sep), -1)
    return spark.read.text(path).select(parts[0].try_cast("bigint").alias("itemid"),
                                        parts[1].alias("title"))


def read_personal_ratings(spark: SparkSession, path: str, sep: str = "::") -> DataFrame:
    """Ratings above zero; fails when the user rated nothing."""
    parts = F.split("value", literal_pattern(sep), -1)
    rated = spark.read.text(path).select(
        parts[0].try_cast("bigint").alias("userid"), parts[1].try_cast("bigint").alias("itemid"),
        parts[2].try_cast("double").alias("rate")).where(F.col("rate") > 0)
    if rated.isEmpty():
        raise ValueError("no ratings provided")
    return rated


def parse_app_dict(lines: DataFrame, sep: str = ",") -> DataFrame:
    """``(appid, appname)`` from fields 1 and 2 of lines with at least five fields."""
    parts = F.split("value", literal_pattern(sep), -1)
    return lines.select(parts.alias("p")).where(F.size("p") >= 5).select(
        F.col("p")[1].alias("appid"), F.col("p")[2].alias("appname"))


def read_app_dict(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return parse_app_dict(spark.read.text(path), sep)


def read_sparse_points(spark: SparkSession, path: str) -> DataFrame:
    """``(label, features)`` from lines ``(label,(size,[i1,i2,...],[v1,v2,...]))``: sparse vectors."""
    pattern = r"^\(\s*([^,]+)\s*,\s*\(\s*(\d+)\s*,\s*\[(.*)\]\s*,\s*\[(.*)\]\s*\)\s*\)$"
    part = lambda i: F.regexp_extract("value", pattern, i)
    numbers = lambda i, t: F.transform(F.filter(F.split(part(i), ","), lambda v: F.trim(v) != ""),
                                       lambda v: F.trim(v).try_cast(t))
    return spark.read.text(path).select(
        part(1).try_cast("double").alias("label"),
        sparse_vector(part(2).try_cast("int"), numbers(3, "int"), numbers(4, "double")).alias("features"))


def read_labeled_points(spark: SparkSession, path: str) -> DataFrame:
    """``(label, features)`` from lines ``(label,[f1,f2,...])``: dense vectors."""
    pattern = r"^\(\s*([^,]+)\s*,\s*\[(.*)\]\s*\)$"
    values = F.transform(F.split(F.regexp_extract("value", pattern, 2), ","),
                         lambda v: F.trim(v).try_cast("double"))
    return spark.read.text(path).select(
        F.regexp_extract("value", pattern, 1).try_cast("double").alias("label"),
        array_to_vector(values).alias("features"))
