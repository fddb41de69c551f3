"""Mixing sources to target weights by systematic sampling.

Every document of a source expects ``target / source size`` copies.  Documents are
laid out per source by size, their expected copies are summed up, and one random
offset decides where the whole numbers fall: a document is emitted once for each
whole number its stretch crosses.  Laying out by size keeps the words taken within
about one document of the target, however uneven the sizes are.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.ranking import numbered
from ..session import materialize
from .common import WORD, read, word_count

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 1


def offset(seed: int) -> float:
    """The random offset in [0, 1), a multiple of 2**-20 and so exact in decimal digits."""
    return random.Random(seed).randrange(2**20) / 2**20


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` of rows ``(source, size)``.

    Sources by code point, null last, take the weights in turn and share the sum of all
    sizes.  A target stops at ``most`` (at least 1) times its source; what is over is
    shared again by weight.  That is one level per unit of weight: with
    the sources ordered by limit over weight, those below the level stop.  The windows
    run over one row per source.
    """
    if most < 1 or not weights or min(weights) <= 0:
        raise ValueError("weights must be positive and most at least 1")
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          F.pmod(place - 1, F.lit(len(weights))) + 1)
    src = (src.withColumn("_i", place).withColumn("_w", weight)
           .withColumn("_limit", F.col("source_size") * F.lit(float(most))))
    every = Window.orderBy(F.col("_limit") / F.col("_w"), "_i")
    all_rows = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stopped = F.coalesce(F.sum("_limit").over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("_w").over(every.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    src = src.withColumn("_level", (F.sum("source_size").over(all_rows) - stopped) / left)
    full = F.col("_limit") / F.col("_w") <= F.col("_level")
    src = src.withColumn("_level", F.max(F.when(~full, F.col("_level"))).over(all_rows))
    open_ = F.col("_limit") / F.col("_w") > F.col("_level")
    return src.select("source", "source_size",
                      F.when(open_, F.col("_w") * F.col("_level")).otherwise(F.col("_limit")).alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, seed: int = SEED) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)``, one row per row of ``docs``.

    ``docs`` needs doc_id, source and text; other columns are ignored.  Null or empty texts
    have size 0 and may still be emitted.  A source without words takes nothing.
    Repeated rows are documents of their own, in any order among themselves.  An empty
    table gives an empty one.  ``copies`` never exceeds ``most`` rounded up.
    """
    return mix_sizes(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), weights, most, seed)


def mix_sizes(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, seed: int = SEED) -> DataFrame:
    """As :func:`mix`, from rows ``(doc_id, source, size)``."""
    sizes = materialize(sizes, "mix-sizes")
    goal = targets(sizes, weights, most).withColumnRenamed("source", "_source")
    ranked = numbered(sizes, ["source"], ["size", "doc_id"], "mix-order")
    per = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    u = F.lit(offset(seed))
    rank = F.col("rank").cast("double")
    copies = F.floor(per * rank + u) - F.floor(per * (rank - 1) + u)
    return (ranked.join(goal, F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("copies", copies.cast("long"))
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def emit(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Every row is a document of its own, whatever its id: rows without an id and rows that share one too.  The
    rows are written with a number first, so that reruns agree.
    """
    rows = materialize(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "mix-rows")
    taken = mix_sizes(rows.select(F.col("_mix_row").alias("doc_id"), "source", word_count(F.col("text")).alias("size")),
                      weights, most, seed).where(F.col("copies") > 0).select(
        F.col("doc_id").alias("_mix_row"), F.col("copies").alias("_mix_copies"))
    return (rows.join(taken, "_mix_row")
            .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_copies"))))
            .select(*docs.columns))


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents", "doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def emission_sql(sizes: str) -> str:
    """Table expressions up to ``emitted``, over a query of (doc_id, source, size)."""
    return f"""
sizes AS ({sizes}),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} AS DOUBLE) AS w
        FROM sizes GROUP BY source),
lim AS (SELECT *, source_size * {MOST}.0::DOUBLE AS lim, source_size * {MOST}.0::DOUBLE / w AS ratio,
               row_number() OVER (ORDER BY source NULLS LAST) AS i FROM src),
lev AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(lim) OVER (
                     ORDER BY ratio, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                  / sum(w) OVER (ORDER BY ratio, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
        FROM lim),
goal AS (SELECT source, source_size,
                CASE WHEN ratio > (SELECT max(lv) FROM lev WHERE ratio > lv)
                     THEN w * (SELECT max(lv) FROM lev WHERE ratio > lv) ELSE lim END AS target FROM lev),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS r FROM sizes),
emitted AS (SELECT doc_id, size, source_size, target, ranked.source,
       CAST(floor(target / source_size * r + {offset(SEED)!r}::DOUBLE)
            - floor(target / source_size * (r - 1) + {offset(SEED)!r}::DOUBLE) AS BIGINT) AS copies
       FROM ranked JOIN goal ON ranked.source IS NOT DISTINCT FROM goal.source)"""


ORACLE = f"""WITH {emission_sql(f"""SELECT doc_id, source,
  CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size FROM documents""")}
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM emitted"""
