"""User- and item-based collaborative filtering."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..session import materialize, materialize_rounds
from .neighbours import NEIGHBOURS, item_neighbours, pair_sums, user_neighbours
from .ranking import tasks_for, top_k, with_key_count

TOP = 20
LIST = 1000          # ratings of a user that travel in one row
MOST = 4_000_000     # contributions above which a user's items are not summed in one task
ROUND = 400_000_000  # contributions, some 11 bytes each, that are shuffled at a time


def cap(ratings: DataFrame, n: int | None = None) -> DataFrame:
    """The best-rated ``n`` rows per user; all rows if ``n`` is not given."""
    rows = ratings.select("userid", "itemid", "rate")
    return rows if n is None else top_k(rows, ["userid"], [F.desc("rate"), F.asc("itemid")], n)


def with_counts(ratings: DataFrame) -> DataFrame:
    """Attach rows per user and per item, counted by aggregation."""
    return with_key_count(with_key_count(ratings, "userid", "n_user"), "itemid", "n_item")


def kept_pair_stats(near: DataFrame) -> DataFrame:
    """The sums of a neighbour list ``near(a, b)`` with its ``sums``, each pair once as ``a < b``.

    They come with the list, so no rating is met again.
    """
    swap = {"a": "b", "b": "a", "sx": "sy", "sy": "sx", "sxx": "syy", "syy": "sxx", "na": "nb", "nb": "na"}
    up = F.col("a") < F.col("b")
    sides = near.select("size", "dot", *[F.when(up, F.col(c)).otherwise(F.col(d)).alias(c) for c, d in swap.items()])
    return sides.dropDuplicates(["a", "b"])


def pair_similarity(size: Column, dot: Column, sxx: Column, syy: Column,
                    na: Column, nb: Column) -> Column:
    cos = S.cosine(dot, F.sqrt(sxx), F.sqrt(syy))
    return F.round(S.significance(cos, size, na, nb), 9)


def weighted_scores(contributions: DataFrame, seen: DataFrame, k: int = TOP) -> DataFrame:
    """Weighted mean per (user, item), minus seen pairs, best ``k`` per user.

    Aggregation and anti join use the same two keys, so the large side is
    shuffled once for both.
    """
    scored = contributions.groupBy("userid", "itemid").agg(
        F.sum("ws").alias("_ws"), F.sum("w").alias("_w"))
    return _best_scores(scored.join(seen.select("userid", "itemid"), ["userid", "itemid"], "left_anti"), k)


def _best_scores(fresh: DataFrame, k: int) -> DataFrame:
    score = F.round(F.try_divide("_ws", "_w"), 9)
    ranked = fresh.select("userid", "itemid", score.alias("score")).where(
        F.col("score").isNotNull() & ~F.isnan("score"))
    return top_k(ranked, ["userid"], [F.desc("score"), F.asc("itemid")], k)


def _scores_of_lists(lists: DataFrame, weight: str, seen: DataFrame, k: int, load: DataFrame) -> DataFrame:
    """:func:`weighted_scores` of contributions that come as ``lists(userid, f, items, vs)``.

    Each item stands for the weighted rate ``f * v``; its weight is ``v`` or ``f``, as ``weight`` says.  The lists
    travel to their user's partition and are summed and ranked there.  ``load(userid, n)`` counts what a user gets;
    one who gets more than ``MOST`` is spread over all partitions by item instead.  Beyond ``ROUND`` in all, the users
    take turns, and each turn's scores are written before the next one's lists are shuffled: pass stored tables.
    """
    at = F.get("vs", F.col("_at"))
    load = materialize(load.select("userid", "n"), "cf-load")
    heavy = load.where(F.col("n") > MOST).select("userid")

    def each(some: DataFrame) -> DataFrame:
        return some.select("userid", "f", "vs", "_seen", F.posexplode("items").alias("_at", "itemid")).select(
            "userid", "itemid", "_seen", (at if weight == "v" else F.col("f")).alias("w"), (at * F.col("f")).alias("ws"))

    # a null id has been seen by nobody, as in the join
    marks = seen.dropna(subset=["userid", "itemid"]).select("userid", F.lit(None).cast("double").alias("f"), F.array("itemid").alias("items"),
                        F.array(F.lit(None).cast("double")).alias("vs"), F.lit(True).alias("_seen"))
    total = load.agg(F.sum("n"), F.max("n")).first()
    many = (total[1] or 0) > MOST
    rounds = max(1, math.ceil((total[0] or 0) / ROUND))

    def scores(lists: DataFrame, marks: DataFrame, seen: DataFrame) -> DataFrame:
        rows = lists.withColumn("_seen", F.lit(False)).unionByName(marks)
        light = rows.join(heavy, "userid", "left_anti") if many else rows
        scored = each(light.repartition(tasks_for(lists.sparkSession, (total[0] or 0) / rounds), "userid")).groupBy("userid", "itemid").agg(
            F.sum("ws").alias("_ws"), F.sum("w").alias("_w"), F.max("_seen").alias("_seen")).where(~F.col("_seen"))
        best = _best_scores(scored, k)
        if not many:
            return best
        dense = each(lists.withColumn("_seen", F.lit(False)).join(heavy, "userid", "left_semi"))
        return best.unionByName(weighted_scores(dense, seen, k))

    if rounds == 1:
        return scores(lists, marks, seen)
    turn = F.pmod(F.xxhash64("userid"), F.lit(rounds))
    return materialize_rounds((scores(*[df.where(turn == r) for df in (lists, marks, seen)]) for r in range(rounds)), "cf-scores")


def item_cf(ratings: DataFrame, cap_n: int | None = None, neighbours: int = NEIGHBOURS,
            k: int = TOP) -> DataFrame:
    """Score ``j`` for ``u`` from the items ``i`` that ``u`` rated and ``i -> j``.

    ``cap_n``: keep only each user's best-rated rows; by default all count.
    """
    ratings = materialize(ratings.select("userid", "itemid", "rate"), "cf-ratings")
    kept = ratings if cap_n is None else materialize(cap(ratings, cap_n), "cf-capped")
    near = materialize(item_neighbours(kept, neighbours).groupBy(F.col("a").alias("itemid")).agg(
        F.collect_list(F.struct("b", "sim")).alias("l")), "cf-near")
    lists = kept.join(near, "itemid").select(
        "userid", F.col("rate").alias("f"), F.col("l.b").alias("items"), F.col("l.sim").alias("vs"))
    load = kept.groupBy("userid").agg((F.count("*") * neighbours).alias("n"))
    return _scores_of_lists(lists, "v", ratings, k, load)


def user_cf(ratings: DataFrame, cap_n: int | None = None, neighbours: int = NEIGHBOURS,
            k: int = TOP) -> DataFrame:
    """A rating of ``u`` is pushed to ``u``'s neighbours.  ``cap_n`` as in :func:`item_cf`."""
    kept = materialize(cap(ratings, cap_n), "cf-ratings")
    near = materialize(user_neighbours(kept, neighbours), "cf-near")
    counted = with_key_count(kept.where(F.col("userid").isNotNull()), "userid", "n")
    part = F.pmod(F.xxhash64("itemid"), F.ceil(F.col("n") / LIST)).alias("_part")
    owned = materialize(counted.groupBy(F.col("userid").alias("a"), part).agg(
        F.collect_list(F.struct("itemid", "rate")).alias("l")).drop("_part"), "cf-owned")
    lists = near.join(owned, "a").select(
        F.col("b").alias("userid"), F.col("sim").alias("f"), F.col("l.itemid").alias("items"), F.col("l.rate").alias("vs"))
    sizes = kept.groupBy(F.col("userid").alias("a")).agg(F.count("*").alias("n"))
    load = near.join(sizes, "a").groupBy(F.col("b").alias("userid")).agg(F.sum("n").alias("n"))
    return _scores_of_lists(lists, "f", kept, k, load)


def item_cf_for(ratings: DataFrame, users: DataFrame, neighbours: int = NEIGHBOURS, k: int = TOP) -> DataFrame:
    """:func:`item_cf` for some users: only items that they rated get their neighbours.

    Pairs are formed on the full ratings with such an item on one side.
    """
    kept = materialize(cap(ratings), "cf-ratings")
    own = kept.join(users.select("userid"), "userid", "left_semi")
    wanted = own.select("itemid").distinct()
    counted = with_key_count(kept, "itemid", "n")
    left = counted.join(wanted, "itemid", "left_semi").select(
        F.col("userid").alias("_k"), F.col("itemid").alias("a"), F.col("rate").alias("x"), F.col("n").alias("na"))
    right = counted.select(F.col("userid").alias("_k"), F.col("itemid").alias("b"), F.col("rate").alias("y"),
                           F.col("n").alias("nb"))
    stats = pair_sums(left.join(right, "_k").where(F.col("a") != F.col("b")))
    sim = pair_similarity(*[F.col(c) for c in ("size", "dot", "sxx", "syy", "na", "nb")])
    near = top_k(stats.select("a", "b", sim.alias("sim")), ["a"], [F.desc("sim"), F.asc("b")], neighbours)
    hits = own.join(near, own["itemid"] == near["a"]).select(
        "userid", F.col("b").alias("itemid"), F.col("sim").alias("w"), (F.col("sim") * F.col("rate")).alias("ws"))
    return weighted_scores(hits, own, k)
