"""Invariants of model and stream outputs."""

import pytest

import __spark_entry__ as entry
from tastegraph.operators import als, evaluate
from tastegraph.plans import models
from tastegraph.session import materialize
from tastegraph.sources.tables import load_items, load_ratings
from tastegraph.streaming import retrain as R

ROOT = "/root/testdata/sf0.001"
Q = entry.queries()


def test_recommendations_leave_seen_items_out(spark):
    ratings = load_ratings(spark, ROOT)
    recs = als.recommend_unseen(als.train(ratings, 4, 2, 0.1), 1, load_items(spark, ROOT), ratings)
    seen = ratings.where("userid = 1")
    assert 0 < recs.count() <= 20 and recs.join(seen, "itemid").isEmpty()
    scores = [r["score"] for r in recs.collect()]
    assert scores == sorted(scores, reverse=True)


def test_ids_beyond_an_int_stop_the_fit(spark):
    r = spark.createDataFrame([(2**31, 1, 3.0), (1, 1, 2.0)], "userid long, itemid long, rate double")
    with pytest.raises(Exception, match="userid is no 32-bit id: 2147483648"):
        als.train(r, 2, 1, 0.1)


def test_evaluator_agrees_with_matched_rmse(spark):
    r = load_ratings(spark, ROOT)
    scored = als.predict(als.train(r, 4, 2, 0.1), r.select("userid", "itemid", "rate"))
    ours = evaluate.rmse(scored, r).first()[0]
    assert abs(als.regression_rmse(scored) - ours) < 1e-6


def test_grid_takes_the_first_of_the_best(spark):
    r = evaluate.time_split(load_ratings(spark, ROOT))
    model, trials = als.grid_search(r.where("split = 'train'"), r.where("split = 'validation'"), (2, 3), (0.1,), (1, 2))
    assert [t[:3] for t in trials] == [(2, 0.1, 1), (2, 0.1, 2), (3, 0.1, 1), (3, 0.1, 2)]
    assert model.rank == min(trials, key=lambda t: t[3])[0]


def test_stream_by_the_clock(spark, tmp_path):
    """Two batches under the processing-time trigger, then stopped."""
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("1,2,3.5,10\n")
    lines = R.parse_behaviour(R.behaviour_stream(
        spark, "text", {"path": str(src), "maxFilesPerTrigger": "1"}, "value string"))
    paths = [str(tmp_path / p) for p in ("history", "audit", "checkpoint")]
    q = R.store(lines, *paths, trigger="1 second")
    try:
        for name, rows in (("b.txt", "2,2,4,11\n5,5,5,5\n"), (None, "")):
            q.processAllAvailable()
            if name:
                (src / name).write_text(rows)
    finally:
        q.stop()
    audit = sorted((r["batch_rows"], r["history_rows"], r["total_rows"]) for r in spark.read.parquet(paths[1]).collect())
    assert audit == [(1, 0, 1), (2, 1, 3)]


def test_stream_batches_and_replay(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("1,2,3.5,10\nbad line\n2,2,4,11\n")
    lines = lambda: R.parse_behaviour(R.behaviour_stream(
        spark, "text", {"path": str(src), "maxFilesPerTrigger": "1"}, "value string"))
    paths = [str(tmp_path / p) for p in ("history", "audit", "checkpoint")]
    R.store(lines(), *paths, trigger=None).awaitTermination()
    (src / "b.txt").write_text("3,2,1,12\n")
    for _ in range(2):  # the second run finds nothing new
        R.store(lines(), *paths, trigger=None).awaitTermination()
    audit = sorted((r["batch_rows"], r["history_rows"], r["total_rows"])
                   for r in spark.read.parquet(paths[1]).collect())
    assert audit == [(1, 2, 3), (2, 0, 2)]
    R.append_batch(spark.createDataFrame([(3, 2, 1.0, 12)], "userid long, itemid long, rate double, ts long"),
                   1, paths[0])
    assert R.read_history(spark, paths[0]).count() == 3


def test_retrain_serves_only_known_users(spark):
    df = Q["stream_retrain"](spark, ROOT)
    assert df.count() > 0 and df.where("userid >= 30").isEmpty() and df.where("not finite").isEmpty()


def test_concurrent_fits_take_the_first_of_equal_errors(spark, monkeypatch):
    """Whatever ends first; failures are not swallowed."""
    import time

    r = evaluate.time_split(load_ratings(spark, ROOT))
    train, valid = r.where("split = 'train'"), r.where("split = 'validation'")
    fitted, own = als.train(train, 2, 1, 0.1), []

    def slow(df, rank, iters, reg, seed):
        time.sleep(0.3 * (3 - rank))
        own.append(rank)
        return fitted

    monkeypatch.setattr(als, "train", slow)
    monkeypatch.setattr(als, "predict", lambda model, pairs: pairs.withColumn("prediction", pairs["rate"]))
    _, trials = als.grid_search(train, valid, (1, 2, 3), (0.1,), (1,), parallel=3)
    assert own == [3, 2, 1] and trials == [(k, 0.1, 1, 0.0) for k in (1, 2, 3)]
    monkeypatch.setattr(als, "train", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        als.grid_search(train, valid, (1,), (0.1,), (1,))


def test_a_swapped_item_is_not_the_best(spark):
    from pyspark.sql import functions as F

    from tastegraph.plans import models

    model = als.train(load_ratings(spark, ROOT), 4, 2, 0.1)
    recs = als.recommend_all_users(model, 3).where("userid < 20")
    assert models._best(model, recs, "userid", "itemid", 3).agg(F.every("best")).first()[0]
    swapped = recs.withColumn("itemid", F.when(F.col("rank") == 1, F.lit(3)).otherwise(F.col("itemid")))
    assert not models._best(model, swapped, "userid", "itemid", 3).where("rank = 1 AND itemid = 3").agg(F.every("best")).first()[0]


def test_fits_drop_their_shuffle_files_as_they_go(spark, monkeypatch):
    """Every second iteration is written, so a fit keeps the shuffles of two iterations, not of all."""
    from tastegraph.operators import als
    plain, used = als.ALS, []
    monkeypatch.setattr(als, "ALS", lambda **settings: used.append(settings.get("checkpointInterval", 10)) or plain(**settings))
    rows = spark.createDataFrame([(u, i, 1.0 + (u + i) % 4) for u in range(6) for i in range(5)], "userid long, itemid long, rate double")
    assert als.train(rows, 2, 4).itemFactors.count() == 5
    assert used == [als.KEEP] and als.KEEP < 8


def test_check_of_recommendations_sends_no_scores_through_the_driver(spark):
    ratings = load_ratings(spark, ROOT)
    model = als.train(ratings, 4, 2, 0.1)
    recs = materialize(als.recommend_for_users(model, ratings.select("userid").distinct(), 3), "test-recs")
    checked = models._best(model, recs, "userid", "itemid", 3)
    assert "Broadcast" not in checked._jdf.queryExecution().executedPlan().toString()
    assert checked.count() == recs.count() and checked.where("not best").isEmpty()


def test_search_for_one_user_is_a_plain_product(spark):
    from tastegraph.operators import factors
    rows = lambda n: [(i, [float((i * 7 + d * 3) % 11 - 5) for d in range(4)]) for i in range(n)] + [(n, None), (n + 1, [float("nan")] * 4)]
    table = lambda n: spark.createDataFrame(rows(n), "id long, features array<float>")
    got = factors.topk_for_few(table(2), table(200), 9).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, factors.topk_from_factors(table(2), table(200), 9).collect())) and len(got) == 18


def test_unseen_items_are_scored_as_the_model_does(spark):
    """The model's own scores, and no exchange by the one user."""
    ratings = spark.createDataFrame([(u, i, float((u * i) % 5 + 1)) for u in range(12) for i in range(30) if (u + i) % 3], "userid long, itemid long, rate double")
    items = spark.range(40).selectExpr("id AS itemid")
    model = als.train(ratings, rank=3, iters=2, reg=0.1)
    recs = als.recommend_unseen(model, 1, items, ratings, 5)
    assert "userid" not in "".join(line for line in recs._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line)
    want = {r["itemid"]: r["prediction"] for r in als.predict(model, als.unseen_items(items, ratings, 1).selectExpr("1L AS userid", "itemid")).collect()}
    got = recs.collect()
    assert len(got) == 5 and all(abs(r["score"] - want[r["itemid"]]) < 1e-5 for r in got)
    assert min(r["score"] for r in got) >= sorted(want.values())[-5] - 1e-5
