"""Collaborative filtering, splits and evaluation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..operators import cf, evaluate
from ..operators.neighbours import every_pair, item_neighbours, user_neighbours
from ..operators.ranking import chunked_lists
from ..session import materialize
from ..sources.tables import load_items, load_ratings
from . import base_sql  # noqa: F401
from .registry import query

CAP = 30  # of ratings_capped alone: the fixtures hold at most 90 ratings per user, so 100 would not bite
POSTING = 46  # of user_neighbours_lists: items of the fixtures have up to 49 raters, so some become lists


def _stored(spark, root):
    return materialize(cf.cap(load_ratings(spark, root)), "ratings")


#: Written neighbour lists with their sums of this session by application, input and entity.
NEAR: dict[tuple[str, str, str], DataFrame] = {}


def _near(spark, root, entity):
    """The stored neighbour list with its sums, searched once per input."""
    key = (spark.sparkContext.applicationId, root, entity)
    if key not in NEAR:
        search = item_neighbours if entity == "itemid" else user_neighbours
        NEAR[key] = materialize(search(_stored(spark, root), sums=True), "near")
    return NEAR[key]


def _item_pairs(spark, root):
    return cf.kept_pair_stats(_near(spark, root, "itemid"))


def cf_oracle(by: str, target: str, near: str, seen: str) -> str:
    return f"""
SELECT userid, itemid, score FROM (
  SELECT *, row_number() OVER (PARTITION BY userid ORDER BY score DESC, itemid) AS rk FROM (
    SELECT userid, itemid, round(sum(sim * rate) / sum(sim), 9) AS score FROM (
      SELECT {target}, sim, rate FROM ratings c JOIN {near} n ON c.{by} = n.a) h
    WHERE NOT EXISTS (SELECT 1 FROM {seen} s WHERE s.userid = h.userid AND s.itemid = h.itemid)
    GROUP BY 1, 2))
WHERE rk <= 20"""


@query("item_cf", cf_oracle("itemid", "c.userid, n.b AS itemid", "item_near", "ratings"))
def item_cf(spark, root):
    return cf.item_cf(load_ratings(spark, root))


@query("user_cf", cf_oracle("userid", "n.b AS userid, c.itemid", "user_near", "ratings"))
def user_cf(spark, root):
    return cf.user_cf(load_ratings(spark, root))


@query("src_ratings", "SELECT userid, itemid, rate, ts FROM ratings")
def src_ratings(spark, root):
    return load_ratings(spark, root)


@query("filter_user", "SELECT userid, itemid, rate FROM ratings WHERE userid = 1")
def filter_user(spark, root):
    return load_ratings(spark, root).where(F.col("userid") == 1).select("userid", "itemid", "rate")


@query("ratings_capped", "SELECT userid, itemid, rate FROM capped")
def ratings_capped(spark, root):
    return cf.cap(load_ratings(spark, root), CAP)


@query("ratings_with_counts", "SELECT userid, itemid, rate, n_user, n_item FROM counted")
def ratings_with_counts(spark, root):
    return cf.with_counts(load_ratings(spark, root)).select(
        "userid", "itemid", "rate", "n_user", "n_item")


PAIR_COLUMNS = ["a", "b", "size", "dot", "sx", "sy", "sxx", "syy", "na", "nb"]


@query("item_pair_stats", f"SELECT {', '.join(PAIR_COLUMNS)} FROM item_pairs")
def item_pair_stats(spark, root):
    """Sums of every pair of items that some user rated both of."""
    return every_pair(_stored(spark, root), "itemid", "userid").select(*PAIR_COLUMNS)


@query("user_pair_stats", f"SELECT {', '.join(PAIR_COLUMNS)} FROM user_pairs")
def user_pair_stats(spark, root):
    return every_pair(_stored(spark, root), "userid", "itemid").select(*PAIR_COLUMNS)


@query("item_neighbours", "SELECT a, b, sim FROM item_near")
def item_neighbours_query(spark, root):
    return item_neighbours(_stored(spark, root))


@query("user_neighbours", "SELECT a, b, sim FROM user_near")
def user_neighbours_query(spark, root):
    return user_neighbours(_stored(spark, root))


@query("user_neighbours_lists", "SELECT a, b, sim FROM user_near")
def user_neighbours_lists(spark, root):
    """The same result, with the most popular items read as lists."""
    return user_neighbours(_stored(spark, root), posting=POSTING)


@query("sim_cosine", "SELECT a, b, round(dot / (sqrt(sxx) * sqrt(syy)), 6) AS cosine FROM item_kept")
def sim_cosine(spark, root):
    s = _item_pairs(spark, root)
    return s.select("a", "b", F.round(S.cosine(F.col("dot"), F.sqrt("sxx"), F.sqrt("syy")), 6)
                    .alias("cosine"))


NUM = "(size * dot - sx * sy)"
DEN = "(sqrt(size * sxx - sx * sx) * sqrt(size * syy - sy * sy))"


def _corr(smooth):
    return S.correlation(*[F.col(c) for c in ("size", "dot", "sx", "sy", "sxx", "syy")], smooth)


@query("sim_correlation", f"""
SELECT a, b, round(CASE WHEN {DEN} <> 0 THEN {NUM} / {DEN} END, 6) AS corr FROM item_pairs""")
def sim_correlation(spark, root):
    """Of every pair of items that some user rated both of."""
    return every_pair(_stored(spark, root), "itemid", "userid").select(
        "a", "b", F.round(_corr(0), 6).alias("corr"))


@query("sim_correlation_smoothed",
       f"SELECT a, b, round({NUM} / ({DEN} + 1), 6) AS corr FROM item_kept")
def sim_correlation_smoothed(spark, root):
    return _item_pairs(spark, root).select(
        "a", "b", F.round(_corr(1), 6).alias("corr"))


@query("sim_regularized", f"""
SELECT a, b, round(size / (size + 10.0) * ({NUM} / ({DEN} + 1))
                   + (1 - size / (size + 10.0)) * 0.1, 6) AS corr FROM item_kept""")
def sim_regularized(spark, root):
    return _item_pairs(spark, root).select(
        "a", "b", F.round(S.regularized(F.col("size"), _corr(1), 10, 0.1), 6).alias("corr"))


@query("dataset_stats", """
SELECT count(*) AS n_ratings, count(DISTINCT userid) AS n_users,
       count(DISTINCT itemid) AS n_items FROM ratings""")
def dataset_stats(spark, root):
    return evaluate.dataset_stats(load_ratings(spark, root))


@query("split_time_key", """
SELECT userid, itemid, rate, ts, split,
       CASE WHEN ts % 10 < 6 THEN 'train' WHEN ts % 10 < 8 THEN 'validation'
            WHEN ts % 10 > 8 THEN 'test' END AS split_from_9 FROM splits""")
def split_time_key(spark, root):
    df = evaluate.time_split(load_ratings(spark, root), 8)
    return df.withColumn("split_from_9", evaluate.time_split_label(F.col("ts"), 9))


@query("split_sizes", "SELECT split, count(*) AS n FROM splits GROUP BY 1")
def split_sizes(spark, root):
    return evaluate.time_split(load_ratings(spark, root)).groupBy("split").agg(
        F.count("*").alias("n"))


@query("split_hash", """
SELECT userid, itemid, bucket, CASE WHEN bucket < 60 THEN 'train' WHEN bucket < 80
       THEN 'validation' ELSE 'test' END AS split FROM (
  SELECT userid, itemid, CAST(('0x' || substr(md5(userid::VARCHAR || ':' || itemid::VARCHAR), 1, 8))
         AS BIGINT) % 100 AS bucket FROM ratings)""")
def split_hash(spark, root):
    return evaluate.hash_split(load_ratings(spark, root)).select(
        "userid", "itemid", "bucket", "split")


@query("sample_limit", """
SELECT userid, itemid, rate FROM ratings ORDER BY userid, itemid LIMIT 50000""")
def sample_limit(spark, root):
    return (load_ratings(spark, root).select("userid", "itemid", "rate")
            .orderBy("userid", "itemid").limit(50000))


@query("training_set", """
SELECT userid, itemid, rate FROM splits WHERE split = 'train'
UNION ALL SELECT userid, itemid, rate FROM ratings WHERE userid = 1""")
def training_set(spark, root):
    from ..operators.als import training_set as build
    r = load_ratings(spark, root)
    return build(r, r.where(F.col("userid") == 1))


@query("implicit_shift", "SELECT userid, itemid, rate - 2.5 AS confidence FROM ratings")
def implicit_shift(spark, root):
    from ..operators.als import implicit_shift as shift
    return load_ratings(spark, root).select("userid", "itemid",
                                            shift(F.col("rate")).alias("confidence"))


@query("implicit_labels", """
SELECT t.userid, t.itemid, CASE WHEN t.rate - 2.5 > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
       round(greatest(least(t.prediction - 2.5, 1.0), 0.0), 6) AS clipped FROM predicted t
WHERE t.prediction IS NOT NULL""")
def implicit_labels(spark, root):
    from ..operators.als import implicit_label, implicit_shift as shift
    joined = _predicted(spark, root).where(F.col("prediction").isNotNull())
    return joined.select(
        "userid", "itemid", implicit_label(shift(F.col("rate"))).alias("label"),
        F.round(evaluate.clip01(shift(F.col("prediction"))), 6).alias("clipped"))


def _predicted(spark, root):
    df = evaluate.time_split(load_ratings(spark, root))
    means = evaluate.item_means(df.where(F.col("split") == "train"))
    test = df.where(F.col("split") == "test").select("userid", "itemid", "rate")
    return test.join(means, "itemid", "left")


def _scored(spark, root):
    """Predictions and actual rows of the test split as two tables."""
    both = _predicted(spark, root)
    return (both.where(F.col("prediction").isNotNull()).select("userid", "itemid", "prediction"),
            both.select("userid", "itemid", "rate"))


@query("eval_rmse", """
SELECT count(*) AS n_all, count(prediction) AS n_matched,
       round(sqrt(sum((prediction - rate) ** 2) / count(*)), 6) AS rmse_over_n,
       round(sqrt(avg((prediction - rate) ** 2)), 6) AS rmse_matched FROM predicted""")
def eval_rmse(spark, root):
    e = evaluate.errors(evaluate.join_predictions(*_scored(spark, root)))
    return e.select("n_all", "n_matched", F.round("rmse_over_n", 6).alias("rmse_over_n"),
                    F.round("rmse_matched", 6).alias("rmse_matched"))


@query("eval_mse", """
SELECT round(avg((prediction - rate) ** 2), 6) AS mse, count(prediction) AS n FROM predicted""")
def eval_mse(spark, root):
    return evaluate.errors(_predicted(spark, root)).select(
        F.round("mse", 6).alias("mse"), F.col("n_matched").alias("n"))


@query("eval_baseline", """
SELECT round(mean_rate, 6) AS mean_rate, round(b, 6) AS baseline_rmse, round(t, 6) AS test_rmse,
       round((b - t) / b * 100, 6) AS improvement
FROM (SELECT mean_rate, (SELECT sqrt(avg((rate - mean_rate) ** 2)) FROM splits WHERE split = 'test') AS b,
             (SELECT sqrt(sum((prediction - rate) ** 2) / count(*)) FROM predicted) AS t
      FROM (SELECT avg(rate) AS mean_rate FROM splits WHERE split <> 'test'))""")
def eval_baseline(spark, root):
    base = evaluate.baseline(evaluate.time_split(load_ratings(spark, root)))
    test = evaluate.errors(_predicted(spark, root)).select(F.col("rmse_over_n").alias("t"))
    one = base.withColumn("_k", F.lit(1)).join(test.withColumn("_k", F.lit(1)), "_k")
    return one.select(
        F.round("mean_rate", 6).alias("mean_rate"), F.round("baseline_rmse", 6).alias("baseline_rmse"),
        F.round("t", 6).alias("test_rmse"),
        F.round(evaluate.improvement(F.col("baseline_rmse"), F.col("t")), 6).alias("improvement"))


@query("eval_pred_sorted", """
SELECT userid, itemid, round(prediction, 6) AS prediction, rate FROM predicted
WHERE prediction IS NOT NULL ORDER BY userid DESC, itemid""")
def eval_pred_sorted(spark, root):
    df = _predicted(spark, root).where(F.col("prediction").isNotNull())
    return df.select("userid", "itemid", F.round("prediction", 6).alias("prediction"), "rate") \
        .orderBy(F.desc("userid"), F.asc("itemid"))


@query("unseen_candidates", """
SELECT itemid FROM items WHERE itemid NOT IN (SELECT itemid FROM ratings WHERE userid = 1)""")
def unseen_candidates(spark, root):
    from ..operators.als import unseen_items
    return unseen_items(load_items(spark, root), load_ratings(spark, root), 1)


@query("user_seen_items", """
SELECT userid, part, array_to_string(list_sort(list(itemid)), ',') AS items, count(*) AS n FROM (
  SELECT userid, itemid,
         CAST(('0x' || substr(md5(itemid::VARCHAR), 1, 8)) AS BIGINT)
         % CAST(ceil(count(*) OVER (PARTITION BY userid) / 1000.0) AS BIGINT) AS part
  FROM ratings) GROUP BY 1, 2""")
def user_seen_items(spark, root):
    seen = chunked_lists(load_ratings(spark, root), "userid", "itemid")
    return seen.select("userid", "part", F.array_join(
        F.transform("values", lambda v: v.cast("string")), ",").alias("items"), "n")


@query("recs_with_titles", f"""
SELECT r.itemid, i.title, r.score FROM (
  SELECT itemid, score FROM ({cf_oracle("itemid", "c.userid, n.b AS itemid", "item_near", "ratings")})
  WHERE userid = 1 ORDER BY score DESC, itemid LIMIT 10) r JOIN items i ON r.itemid = i.itemid""")
def recs_with_titles(spark, root):
    ratings = load_ratings(spark, root)
    recs = cf.item_cf_for(ratings, ratings.where(F.col("userid") == 1).select("userid").distinct())
    best = recs.orderBy(F.desc("score"), F.asc("itemid")).limit(10)
    # the left side is the ten rows of the limit, so it is the one that is broadcast
    return (load_items(spark, root).join(F.broadcast(best), "itemid")
            .select("itemid", "title", "score"))
