"""Ratings, items and tags derived from the star-schema tables.

A deployment with its own ``ratings``/``items``/``tags`` tables passes those to
the operators instead; the operators only look at column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, root: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{root}/{name}.parquet")
    return df.select(*columns) if columns else df


def epoch_days(c: str):
    return F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")


def load_ratings(spark: SparkSession, root: str) -> DataFrame:
    """``(userid, itemid, rate, ts)``: one rating per customer and part."""
    lines = table(spark, root, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    orders = table(spark, root, "orders", "o_orderkey", "o_custkey")
    return (lines.join(orders, lines.l_orderkey == orders.o_orderkey)
            .groupBy(F.col("o_custkey").alias("userid"), F.col("l_partkey").alias("itemid"))
            .agg((1 + F.lit(0.5) * F.pmod(F.sum("l_quantity").cast("bigint"), F.lit(9)))
                 .cast("double").alias("rate"),
                 F.max(epoch_days("l_shipdate")).alias("ts")))


def load_items(spark: SparkSession, root: str) -> DataFrame:
    """``(itemid, title, genre)``; every eleventh title carries no year."""
    year = (1950 + F.pmod("p_partkey", F.lit(70))).cast("string")
    title = F.when(F.pmod("p_partkey", F.lit(11)) == 0, F.col("p_name")).otherwise(
        F.concat("p_name", F.lit(" ("), year, F.lit(")")))
    genre = F.concat("p_type", F.lit("|"), F.upper(F.element_at(F.split("p_name", " "), 2)))
    return table(spark, root, "part", "p_partkey", "p_name", "p_type").select(
        F.col("p_partkey").alias("itemid"), title.alias("title"), genre.alias("genre"))


def load_tags(spark: SparkSession, root: str) -> DataFrame:
    """``(itemid, tag)`` multiset: one tag per order line, its kind by line number."""
    lines = table(spark, root, "lineitem", "l_partkey", "l_linenumber")
    part = table(spark, root, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    words = F.split("p_name", " ")
    kind, brand = F.lower("p_type"), F.lower("p_brand")
    tag = (F.when(F.col("l_linenumber") == 1, F.element_at(words, 1))
           .when(F.col("l_linenumber") == 2, F.element_at(words, 2))
           .when(F.col("l_linenumber") == 3, F.col("p_name"))
           .when(F.col("l_linenumber") == 4, kind)
           .when(F.col("l_linenumber") == 5,
                 F.concat_ws(" ", kind, F.pmod("p_size", F.lit(10)).cast("string")))
           .when(F.col("l_linenumber") == 6, brand)
           .when(F.col("l_linenumber") == 7,
                 F.concat_ws(" ", F.col("p_name"), kind, brand, F.lit("size"),
                             F.col("p_size").cast("string"))))
    return (lines.join(part, lines.l_partkey == part.p_partkey)
            .select(F.col("l_partkey").alias("itemid"), tag.alias("tag"))
            .where(F.col("tag").isNotNull()))
