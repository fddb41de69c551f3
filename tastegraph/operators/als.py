"""Matrix factorisation jobs on ``pyspark.ml``."""

from __future__ import annotations

import gc
import math
import threading
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, prepare_checkpoints, shuffles_dropped
from . import evaluate
from .factors import dot, topk_of_all

# The three tuning grids (ranks, regularisation, iterations).
FULL_GRID = {"ranks": (5, 8, 12, 15), "regs": (0.1, 0.5, 5.0), "iters": (8, 10, 20)}
WIDE_GRID = {"ranks": (8, 12), "regs": (0.1, 10.0), "iters": (10, 20)}
NARROW_GRID = {"ranks": (8, 12), "regs": (0.01, 0.1), "iters": (10, 20)}
IMPLICIT_OFFSET = 2.5
#: Fits of a grid at a time, and ratings that these may have in all; a larger fit runs alone.
FITS = 4
FIT_RATINGS = 4_000_000
#: Ratings of a block; the library builds a block in one task's memory.
BLOCK_RATINGS = 6_000_000
#: Iterations after which the factors are written and the shuffle files before them dropped; one if a fit runs alone.
KEEP = 2


def implicit_shift(rate: Column, offset: float = IMPLICIT_OFFSET) -> Column:
    """Confidence around the rating that means neither like nor dislike."""
    return rate - F.lit(offset)


def implicit_label(confidence: Column) -> Column:
    return F.when(confidence > 0, F.lit(1.0)).otherwise(F.lit(0.0))


def training_set(ratings: DataFrame, personal: DataFrame, test_from: int = 8) -> DataFrame:
    """Training split plus the target user's rows; a row in both counts twice."""
    train = evaluate.time_split(ratings, test_from).where(F.col("split") == "train")
    columns = ["userid", "itemid", "rate"]
    return train.select(*columns).unionByName(personal.select(*columns))


def unseen_items(items: DataFrame, ratings: DataFrame, user: int) -> DataFrame:
    seen = ratings.where(F.col("userid") == user).select("itemid")
    return items.select("itemid").join(seen, "itemid", "left_anti")


def train(ratings: DataFrame, rank: int = 10, iters: int = 20, reg: float = 1.0,
          implicit: bool = False, user_blocks: int = -1, item_blocks: int = -1,
          seed: int = 42) -> ALSModel:
    """Fit; ``-1`` blocks mean the library default of ten, or as many as hold ``BLOCK_RATINGS`` ratings each.

    The ratings are read twice: pass a stored table.  The library takes ids as ints and ratings as floats; an id that is no int stops the job.
    """
    prepare_checkpoints(ratings.sparkSession)
    rows = ratings.count()
    blocks = max(10, math.ceil(rows / BLOCK_RATINGS))
    als = ALS(userCol="userid", itemCol="itemid", ratingCol="rate", rank=rank, maxIter=iters,
              regParam=reg, implicitPrefs=implicit, coldStartStrategy="drop", seed=seed,
              checkpointInterval=KEEP if rows <= FIT_RATINGS else 1,
              numUserBlocks=blocks if user_blocks < 0 else user_blocks,
              numItemBlocks=blocks if item_blocks < 0 else item_blocks)
    # the ordering of rows inside a block follows the shuffle
    return als.fit(ratings.select(_int_id("userid"), _int_id("itemid"), F.col("rate").cast("float").alias("rate")))


def _int_id(name: str) -> Column:
    fits = F.col(name).between(-2**31, 2**31 - 1)
    return F.when(fits, F.col(name).cast("int")).otherwise(F.raise_error(F.concat(
        F.lit(f"{name} is no 32-bit id: "), F.coalesce(F.col(name).cast("string"), F.lit("null")))).cast("int")).alias(name)


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Scores as doubles, ids as bigint again; unknown ids give no row."""
    scored = model.transform(pairs)
    return scored.withColumns({"userid": F.col("userid").cast("bigint"),
                               "itemid": F.col("itemid").cast("bigint"),
                               "prediction": F.col("prediction").cast("double")})


def grid_search(train_df: DataFrame, valid: DataFrame, ranks, regs, iters,
                seed: int = 42, parallel: int = FITS) -> tuple[ALSModel, list[tuple]]:
    """Fit every combination; the first of equal validation errors wins, whichever ends first.

    ``parallel`` combinations are fitted at a time, each from a thread that has the session's
    settings, so the small last tasks of one fit leave no core idle.  All read one stored input.  Only the two
    error sums of a fit come back to the driver, and no model but the best so far is kept: what a fit leaves in memory and
    on disk goes as soon as it ends.
    """
    train_df, valid = materialize(train_df, "als-train"), materialize(valid, "als-valid")
    spark = train_df.sparkSession
    parallel = max(1, min(parallel, FIT_RATINGS // max(1, train_df.count())))
    settings = list(product(ranks, regs, iters))
    best: list = [None, (float("inf"), len(settings))]
    turn = threading.Lock()

    def fit(place: int) -> float:
        rank, reg, it = settings[place]
        model = train(train_df, rank, it, reg, seed=seed)
        scored = predict(model, valid.select("userid", "itemid", "rate"))
        row = evaluate.errors(evaluate.join_predictions(scored, valid)).first()
        error = row["rmse_over_n"] if row["rmse_over_n"] is not None else float("inf")
        with turn:
            if (error, place) < best[1]:
                best[:] = model, (error, place)
        del model, scored
        _collect_garbage(spark)
        return float(error)

    with shuffles_dropped(spark), ThreadPoolExecutor(parallel) as pool:
        own = [pool.submit(inheritable_thread_target(spark)(fit), place) for place in range(len(settings))]
        errors = [f.result() for f in own]
    return best[0], [(rank, float(reg), it, error) for (rank, reg, it), error in zip(settings, errors)]


def _collect_garbage(spark) -> None:
    """The session drops blocks and shuffle files of what nobody refers to, but only once the driver's JVM has noticed."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def recommend_unseen(model: ALSModel, user: int, items: DataFrame, ratings: DataFrame,
                     k: int = 20) -> DataFrame:
    """Best ``k`` catalogue items the user has not rated.

    The user's one vector is sent to the items; as pairs they would all meet it in one task.
    """
    mine = model.userFactors.where(F.col("id") == user).select(F.col("features").cast("array<double>").alias("_u"))
    stock = unseen_items(items, ratings, user).select(_int_id("itemid")).join(
        model.itemFactors.select(F.col("id").alias("itemid"), F.col("features").cast("array<double>").alias("_i")), "itemid")
    scored = stock.crossJoin(F.broadcast(mine)).select(
        F.lit(user).cast("bigint").alias("userid"), F.col("itemid").cast("bigint").alias("itemid"),
        dot("_u", "_i").cast("float").cast("double").alias("score")).where(~F.isnan("score"))
    return scored.orderBy(F.desc("score"), F.asc("itemid")).limit(k)


def flatten_recommendations(recs: DataFrame, key: str, other: str) -> DataFrame:
    return recs.select(F.col(key).cast("bigint").alias(key), F.posexplode("recommendations")).select(
        key, (F.col("pos") + 1).cast("bigint").alias("rank"),
        F.col(f"col.{other}").cast("bigint").alias(other),
        F.col("col.rating").cast("double").alias("score"))


def recommend_for_users(model: ALSModel, users: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` for the given users; seen items stay in, unknown users get no row."""
    return flatten_recommendations(
        model.recommendForUserSubset(users.select("userid"), k), "userid", "itemid")


def recommend_all_users(model: ALSModel, k: int = 10) -> DataFrame:
    """Top ``k`` of all items for every user, from the full product of the factors as floats; ties to smaller ids."""
    return flatten_recommendations(_of_all(model.userFactors, model.itemFactors, k, "userid", "itemid"), "userid", "itemid")


def recommend_all_items(model: ALSModel, k: int = 10) -> DataFrame:
    """The same of all users for every item."""
    return flatten_recommendations(_of_all(model.itemFactors, model.userFactors, k, "itemid", "userid"), "itemid", "userid")


def _of_all(own: DataFrame, others: DataFrame, k: int, key: str, other: str) -> DataFrame:
    return topk_of_all(own, others, k).select(F.col("id").alias(key), F.transform(
        "best", lambda b: F.struct(b["id"].alias(other), b["score"].alias("rating"))).alias("recommendations"))


def factors(model: ALSModel) -> DataFrame:
    side = lambda df, name: df.select(F.lit(name).alias("side"),
                                      F.col("id").cast("bigint").alias("id"), "features")
    return side(model.userFactors, "user").unionByName(side(model.itemFactors, "item"))


def regression_rmse(predictions: DataFrame) -> float:
    return RegressionEvaluator(metricName="rmse", labelCol="rate",
                               predictionCol="prediction").evaluate(predictions)


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)


def pipeline(ratings: DataFrame, items: DataFrame, user: int, grid: dict = FULL_GRID,
             test_from: int = 9, k: int = 20) -> tuple[DataFrame, DataFrame]:
    """Split, tune, test against the mean baseline, recommend for one user.

    Returns the recommendations and a one-row report.
    """
    spark = ratings.sparkSession
    labelled = materialize(evaluate.time_split(ratings, test_from), "als-split")
    personal = labelled.where(F.col("userid") == user)
    fit = labelled.where(F.col("split") == "train").select("userid", "itemid", "rate") \
        .unionByName(personal.select("userid", "itemid", "rate"))
    valid = labelled.where(F.col("split") == "validation")
    test = labelled.where(F.col("split") == "test")
    model, trials = grid_search(fit, valid, grid["ranks"], grid["regs"], grid["iters"])
    rank, reg, iters, val_rmse = min(trials, key=lambda t: t[3])
    scored = predict(model, test.select("userid", "itemid", "rate"))
    test_rmse = evaluate.errors(evaluate.join_predictions(scored, test)).first()["rmse_over_n"]
    base = evaluate.baseline(labelled).first()["baseline_rmse"]
    report = spark.createDataFrame(
        [(rank, reg, iters, val_rmse, test_rmse, base, (base - test_rmse) / base * 100)],
        "rank int, reg double, iters int, validation_rmse double, test_rmse double, "
        "baseline_rmse double, improvement double")
    return recommend_unseen(model, user, items, labelled, k), report
