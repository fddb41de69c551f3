import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegraph.llm import quality, sampling, toxicity

ROOT = "/root/testdata/sf0.1"


def held_out(spark, rows, label):
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{ROOT}/labels.parquet").collect()}
    own = [r for r in rows.where("held_out").collect() if truth.get(r["doc_id"]) is not None]
    return (np.array([truth[r["doc_id"]] for r in own]), np.array([r["score"] for r in own]),
            np.array([r["predicted"] for r in own]))


def auc(y, score):
    rank = score.argsort(kind="stable").argsort()
    n = y.sum()
    return (rank[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


def test_toxicity_held_out(spark):
    y, score, predicted = held_out(spark, toxicity.op4_toxicity(spark, ROOT), "toxic")
    assert auc(y, score) > 0.93
    assert predicted[y == 1].mean() > 0.85 and predicted[y == 0].mean() < 0.03
    assert ((score >= 0.7) == predicted).all()


def test_quality_held_out(spark):
    y, score, predicted = held_out(spark, quality.op6_quality(spark, ROOT), "quality")
    assert auc(y, score) > 0.99
    assert predicted[y == 1].mean() > 0.98 and predicted[y == 0].mean() < 0.06


def test_unlabelled_positives_do_not_count_as_clean():
    rng = np.random.default_rng(1)
    toxic = [np.array([5, 100 + rng.integers(20)]) for _ in range(200)]
    unlabelled = [np.array([5, 100 + rng.integers(20)]) if i % 10 == 0 else np.array([7, 100 + rng.integers(20)])
                  for i in range(1000)]
    model = toxicity.train(toxic, unlabelled, prior=0.1)
    score = lambda *f: sampling.sigmoid(np.array(model.bias + sum(model.weights.get(x, 0) for x in f)))
    assert score(5) > 0.9 and score(7) < 0.1


def test_hinge_loss_by_dual_descent():
    rows = [np.array([0, 1]), np.array([0, 2]), np.array([3, 1]), np.array([3, 2])]
    y = np.array([1, 1, -1, -1])
    w = quality.descend(rows, np.ones(4), y, cost=10.0, rounds=200)
    assert all(k * (w[f].sum() + w[-1]) > 0.99 for f, k in zip(rows, y))
    assert w[0] == pytest.approx(-w[3], abs=0.05)


def test_shapes_know_repetition():
    of = quality.ngrams()
    assert len(of("")) == 0
    assert set(of("Ab cd")) == set(of("Xy zw")) and set(of("ab ab")) != set(of("ab cd"))


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_odd_rows(spark, odd, empty, module, label):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (6, 1), (6, 0), (8, 0), (None, 1), (99, 1)],
                                   f"doc_id long, {label} int")
    nothing = labels.where("doc_id = 3")
    for known in (labels, nothing):
        score = module.scorer(module.learn(odd, known))
        got = {r["doc_id"]: r["s"] for r in odd.select("doc_id", score(F.col("text")).alias("s")).collect()}
        assert len(got) == 11 and all(0 <= s <= 1 for s in got.values())
        assert got[3] == got[4] == got[5]
    score = module.scorer(module.learn(empty, labels))
    assert empty.select(score(F.col("text"))).count() == 0


def test_ends_of_long_tokens_are_seen():
    from tastegraph.llm import quality, toxicity

    of = quality.ngrams()
    long = "語" * 200
    assert set(of(long + "。1。2。3 a")) - set(of(long + " a")) and quality.shape("a-b-c-d-e-f-g-1") != quality.shape("a-b-c-d-e-f-g-!")
    assert quality.cut_words("日本" * 30 + " short") == ["日本" * 6] * 5 + ["short"]
    for clean, toxic in (("これは良い本です", "ばか"), ("fine/", "insult"), ("a-b-c-", "insult")):
        assert set(toxicity.word_features(toxic)) - set(toxicity.word_features(clean)) and any(
            f in toxicity.word_features(clean + toxic) for f in set(toxicity.word_features(toxic)) - set(toxicity.word_features(clean)))
