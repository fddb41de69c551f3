"""Top-k per key and other per-key helpers that stay safe on hot keys."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Largest k for which the planner limits groups below the exchange (its default).
GROUP_LIMIT = 1000
#: Parts of a key that are ranked apart for a larger k.
PARTS = 64
#: Rows that a task forms from lists and groups in memory.
PER_TASK = 500_000


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int,
          rank: str | None = None) -> DataFrame:
    """First ``k`` rows per key.

    ``row_number() <= k`` is planned with a group limit below the exchange, so
    a map task ships at most ``k`` rows per key however hot the key is.  The planner does so up
    to ``GROUP_LIMIT``; for a larger ``k``, parts of a key are ranked first and what
    each part keeps is ranked again.
    """
    name = rank or "_rk"
    if k > GROUP_LIMIT:
        plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]  # maps have no hash
        part = F.pmod(F.xxhash64(*plain), F.lit(PARTS))
        first = Window.partitionBy(*keys, "_part").orderBy(*order)
        df = df.withColumn("_part", part).withColumn("_rk_part", F.row_number().over(first)).where(
            F.col("_rk_part") <= k).drop("_part", "_rk_part")
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    ranked = ranked.where(F.col(name) <= k)
    if rank is None:
        return ranked.drop(name)
    return ranked.withColumn(name, F.col(name).cast("bigint"))


def tasks_for(spark: SparkSession, rows: float) -> int:
    """Partitions for lists that so many rows are formed from: their own size says nothing about the work."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / PER_TASK))


def numbered(df: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """Add ``rank``: the place (from 1) of a row in its group, by ``order``.

    A range sort deals even one hot group over all partitions.  Rows are numbered
    inside their partition, and a table of one row per partition and group carries
    what stands before; no window ever holds a group.  Rows that agree on all
    of group and order may swap places.
    """
    key = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    placed = materialize(df.repartitionByRange(*key).sortWithinPartitions(*key)
                         .withColumn("_at", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    named = [F.col(c).alias(f"_g{i}") for i, c in enumerate(group)]
    runs = placed.groupBy(F.col("_part").alias("_p"), *named).agg(
        F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*[f"_g{i}" for i in range(len(group))] or [F.lit(0)]).orderBy("_p")
    runs = runs.withColumn("_skip", F.sum("_n").over(before) - F.col("_n"))
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return placed.join(runs, same).select(
        *df.columns, (F.col("_at") - F.col("_from") + F.col("_skip") + 1).alias("rank"))


def with_key_count(df: DataFrame, key: str, name: str) -> DataFrame:
    """Attach the number of rows per key.

    Counted with partial aggregation and joined back, not with a window: a
    window would pull every row of a hot key into one task, while the join can
    broadcast the counts or be split by the adaptive skew rule.
    """
    counts = df.groupBy(key).agg(F.count("*").alias(name))
    return df.join(counts, key)


def md5_bucket(text: Column, buckets: Column | int) -> Column:
    """Stable bucket from the first 8 hex digits of the MD5 of ``text``."""
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, buckets if isinstance(buckets, Column) else F.lit(buckets)).cast("bigint")


def chunked_lists(pairs: DataFrame, key: str, value: str, chunk: int = 1000) -> DataFrame:
    """Distinct values per key as sorted arrays of about ``chunk`` values.

    Columns ``(key, part, values, n)``.  A key with more than ``chunk`` values
    is spread over several rows, so neither a task nor a row holds an unbounded
    group; every value is kept.
    """
    distinct = pairs.select(key, value).dropna().distinct()
    sizes = distinct.groupBy(key).agg(
        F.ceil(F.count("*") / F.lit(chunk)).cast("bigint").alias("_parts"))
    placed = distinct.join(sizes, key).withColumn(
        "part", md5_bucket(F.col(value).cast("string"), F.col("_parts")))
    return (placed.groupBy(key, "part")
            .agg(F.sort_array(F.collect_list(value)).alias("values"),
                 F.count("*").alias("n")))
