"""What each filter of a chain removes, under every order of the filters.

Whether a document fails a filter does not depend on the filters before it, so a document
is the set of filters that it fails: a mask.  In an order, it goes at the first filter of its
mask.  The orders that start with the same letters are neighbours in lexicographic order (their Lehmer
ranks are an interval), so the orders in which a mask is removed at a given step are intervals: one for
each way to put filters it passes in front.  Documents are counted per mask, the counts are
added at the beginning and subtracted at the end of each interval, and one prefix sum over the
ranks gives the removals of all orders at once.

Everything after the counts has at most a row per part, rank and step.  Which text is the first of its kind is
decided by a minimum per text and a join on (text, id), so a text that is a third of all rows is no hot key.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import WORD, read

#: Filters in the order of their bits.
FILTERS = "ABCDE"
SUMS = ("removed", "good_lost", "toxic_lost")


def failures(text: Column) -> dict[str, Column]:
    """Failure condition per filter that looks at the text alone; ``text`` is not null."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 80 * F.size(words).cast("long"),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 10 * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]")}


def masks(docs: DataFrame) -> DataFrame:
    """``(doc_id, part, mask)`` per row of ``docs(doc_id, text, lang)``: the filters it fails, a bit each.

    A null text is an empty one, a null lang the empty part.  A row without an id never repeats a
    text, nor is it repeated; rows that share an id do not repeat each other.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    bits = sum((F.when(fails, 1 << FILTERS.index(letter)).otherwise(0) for letter, fails in failures(text).items()), F.lit(0))
    seen = materialize(docs.select(
        F.col("doc_id").cast("long"), F.coalesce("lang", F.lit("")).alias("part"), bits.alias("mask"),
        F.unhex(F.sha2(text, 256)).alias("text_key")), "masks")
    first = seen.groupBy("text_key").agg(F.min("doc_id").alias("doc_id")).where(F.col("doc_id").isNotNull())
    again = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    return seen.join(first.withColumn("_first", F.lit(True)), ["text_key", "doc_id"], "left").select(
        "doc_id", "part", (F.col("mask") + F.when(again, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"))


def rank_of(order: tuple[int, ...], n: int) -> int:
    """Lehmer rank of the first permutation of ``range(n)`` that begins so."""
    left, rank = list(range(n)), 0
    for at, k in enumerate(order):
        rank += left.index(k) * math.factorial(n - 1 - at)
        left.remove(k)
    return rank


def intervals(n: int) -> list[tuple[int, int, int, int]]:
    """``(mask, step, begin, end)``: ranks of the orders of ``n`` filters in which the mask is removed at the step."""
    rows = []
    for step in range(1, n + 1):
        width = math.factorial(n - step)
        for start in itertools.permutations(range(n), step):
            begin, *before = rank_of(start, n), *start[:-1]
            others = [k for k in range(n) if k not in start]
            for more in range(1 << len(others)):  # masks that hold the last of these filters and none before it
                mask = 1 << start[-1] | sum(1 << k for i, k in enumerate(others) if more >> i & 1)
                assert not any(mask >> k & 1 for k in before)
                rows.append((mask, step, begin, begin + width))
    return rows


def audit(tally: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step from ``tally(part, mask, n, good, toxic)``, rows of any number per mask."""
    spark, n = tally.sparkSession, len(filters)
    spans = spark.createDataFrame(intervals(n), "mask int, step int, begin int, end int")
    orders = spark.createDataFrame(
        [(rank, "".join(filters[k] for k in order), step + 1, k)
         for rank, order in enumerate(itertools.permutations(range(n))) for step, k in enumerate(order)],
        "rank int, filter_order string, step int, bit int")  # bounded by the number of filters
    steps = F.explode(F.sequence(F.lit(1), F.lit(n)))
    ends = F.explode(F.array(
        F.struct(F.col("begin").alias("rank"), F.lit(1).alias("sign")),
        F.struct(F.col("end").alias("rank"), F.lit(-1).alias("sign")))).alias("e")
    counts = tally.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    counts = materialize(counts, "mask-counts")
    changes = counts.join(F.broadcast(spans), "mask").select("part", "step", "n", "good", "toxic", ends).select(
        "part", "step", "e.rank", *[(F.col("e.sign") * F.col(a)).alias(b) for a, b in zip(("n", "good", "toxic"), SUMS)])
    totals = counts.groupBy("part").agg(F.sum("n").alias("total"))
    every = totals.select("part", steps.alias("step")).withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(math.factorial(n) - 1))))
    changes = changes.unionByName(every.select("*", *[F.lit(0).cast("long").alias(c) for c in SUMS]))
    changes = changes.groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in SUMS])
    so_far = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = changes.select("part", "step", "rank", *[F.sum(c).over(so_far).alias(c) for c in SUMS])
    bits = F.explode(F.array(*[F.lit(k) for k in range(n)]))
    fails = counts.select("part", "mask", "n", bits.alias("bit")).groupBy("part", "bit").agg(
        F.coalesce(F.sum(F.when(F.expr("(mask >> bit) & 1 = 1"), F.col("n"))), F.lit(0)).alias("_fails"),
        F.coalesce(F.sum(F.when(F.expr("mask = 1 << bit"), F.col("n"))), F.lit(0)).alias("unique_fails"))
    steps_before = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return (removed.join(F.broadcast(orders), ["rank", "step"]).join(fails, ["part", "bit"]).join(totals, "part")
            .select("part", "filter_order", "step",
                    (F.col("total") - F.sum("removed").over(steps_before)).alias("kept"), "removed",
                    (F.col("_fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost",
                    F.sum("removed").over(Window.partitionBy("part", "bit")).alias("shapley")))


def tally(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``.  Documents without a label are neither; where several rows label
    one id, one that says 1 is enough."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    one = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c)
    return masks(docs).join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), one("good"), one("toxic"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(tally(read(spark, sf_dir, "documents", "doc_id", "text", "lang"),
                       read(spark, sf_dir, "labels", "doc_id", "quality", "toxic")))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents),
known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN first_id < doc_id THEN 'E' ELSE '' END AS failed
  FROM words LEFT JOIN known USING (doc_id)),
counts AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5])::INTEGER AS step FROM orders),
held AS (
  SELECT part, filter_order, step, n, good, toxic, contains(failed, filter_order[step]) AS fails, failed = filter_order[step] AS alone,
         len(regexp_extract_all(failed, '[' || filter_order || ']')) > 0
         AND regexp_matches(failed, '[' || filter_order[1:step] || ']') AS gone,
         step > 1 AND regexp_matches(failed, '[' || filter_order[1:greatest(step - 1, 1)] || ']') AS before
  FROM counts, steps),
summed AS (
  SELECT part, filter_order, step, sum(CASE WHEN gone THEN 0 ELSE n END) AS kept,
         sum(CASE WHEN fails AND NOT before THEN n ELSE 0 END) AS removed, sum(CASE WHEN fails AND before THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails AND NOT before THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails AND NOT before THEN toxic ELSE 0 END) AS toxic_lost
  FROM held GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       sum(removed) OVER (PARTITION BY part, filter_order[step])::BIGINT AS shapley
FROM summed
"""
