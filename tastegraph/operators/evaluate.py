"""Splits, error measures and the mean-rating baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import md5_bucket


def time_split_label(ts: Column, test_from: int = 8) -> Column:
    """``train`` for keys 0-5, ``validation`` for 6-7, ``test`` from ``test_from`` on."""
    key = F.pmod(ts, F.lit(10))
    return (F.when(key < 6, "train").when(key < 8, "validation")
            .when(key >= test_from, "test"))


def time_split(df: DataFrame, test_from: int = 8) -> DataFrame:
    return df.withColumn("split", time_split_label(F.col("ts"), test_from))


def hash_split(df: DataFrame, train: int = 60, validation: int = 20) -> DataFrame:
    """Repeatable random split: bucket of 100 from the MD5 of ``user:item``."""
    bucket = md5_bucket(F.concat_ws(":", F.col("userid").cast("string"),
                                    F.col("itemid").cast("string")), 100)
    label = (F.when(bucket < train, "train").when(bucket < train + validation, "validation")
             .otherwise("test"))
    return df.withColumn("bucket", bucket).withColumn("split", label)


def item_means(train: DataFrame) -> DataFrame:
    """Deterministic predictor: mean training rate of the item."""
    return train.groupBy("itemid").agg(F.avg("rate").alias("prediction"))


def clip01(c: Column) -> Column:
    """NULL stays NULL: ``least`` and ``greatest`` alone would skip it."""
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(1.0)), F.lit(0.0)))


def join_predictions(predictions: DataFrame, actual: DataFrame) -> DataFrame:
    """``(userid, itemid, rate, prediction)``; unscored pairs keep a NULL."""
    return actual.select("userid", "itemid", "rate").join(
        predictions.select("userid", "itemid", "prediction"), ["userid", "itemid"], "left")


def errors(joined: DataFrame, clip: bool = False) -> DataFrame:
    """One row: both RMSE denominators, MSE and the two counts, in one pass."""
    p = clip01(F.col("prediction")) if clip else F.col("prediction")
    sq = F.pow(p - F.col("rate"), F.lit(2.0))
    agg = joined.agg(F.sum(sq).alias("_s"), F.count("*").alias("n_all"),
                     F.count("prediction").alias("n_matched"))
    return agg.select(
        "n_all", "n_matched",
        F.sqrt(F.try_divide(F.col("_s"), F.col("n_all"))).alias("rmse_over_n"),
        F.sqrt(F.try_divide(F.col("_s"), F.col("n_matched"))).alias("rmse_matched"),
        F.try_divide(F.col("_s"), F.col("n_matched")).alias("mse"))


def rmse(predictions: DataFrame, actual: DataFrame, denominator: str = "matched",
         clip: bool = False) -> DataFrame:
    column = {"matched": "rmse_matched", "all": "rmse_over_n"}[denominator]
    return errors(join_predictions(predictions, actual), clip).select(F.col(column).alias("rmse"))


def baseline(labelled: DataFrame) -> DataFrame:
    """Mean of train and validation as the prediction for every test row.

    The squared error of a constant is the variance of the test rates plus the squared distance
    of the means, so the whole comparison is one aggregation without a join.
    ``labelled`` carries ``rate`` and ``split``.
    """
    fit, test = F.col("split").isin("train", "validation"), F.col("split") == "test"
    r = F.col("rate")
    agg = labelled.agg(F.avg(F.when(fit, r)).alias("mean_rate"),
                       F.avg(F.when(test, r)).alias("mean_test"), F.var_pop(F.when(test, r)).alias("spread"))
    apart = F.col("mean_test") - F.col("mean_rate")
    return agg.select("mean_rate", F.sqrt(F.col("spread") + apart * apart).alias("baseline_rmse"))


def improvement(baseline_rmse: Column, test_rmse: Column) -> Column:
    return (baseline_rmse - test_rmse) / baseline_rmse * 100


def dataset_stats(ratings: DataFrame) -> DataFrame:
    return ratings.agg(F.count("*").alias("n_ratings"),
                       F.countDistinct("userid").alias("n_users"),
                       F.countDistinct("itemid").alias("n_items"))
