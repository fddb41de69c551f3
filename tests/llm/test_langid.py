import itertools

import numpy as np
import pandas as pd
import pytest

from tastegraph.llm import langid

ROOT = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def learned(spark):
    return langid.learn(spark.read.parquet(f"{ROOT}/documents.parquet"))


def guesses(docs, model):
    from pyspark.sql import functions as F
    return {r["doc_id"]: r for r in docs.select("doc_id", langid.guess(model, F.col("text")).alias("g")).select(
        "doc_id", "g.*").collect()}


def test_held_out_accuracy(spark):
    rows = langid.op2_language(spark, ROOT).where("held_out").collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()}
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in rows]) > 0.97


def test_mixture_of_two(spark, learned):
    docs = {r["lang"]: r["text"] for r in spark.read.parquet(f"{ROOT}/documents.parquet").where(
        "n_chars > 3000").collect()}
    both = docs["de"][:2000] + " " + docs["es"][:1000]
    got = guesses(spark.createDataFrame([(1, both)], "doc_id long, text string"), learned)[1]
    assert got["lang_pred"] == "de" and "es:" in got["mixture"] and 0.55 < got["score"] < 0.8


def test_em_finds_the_shares():
    chance = np.array([[0.7, 0.1], [0.2, 0.2], [0.1, 0.7]])
    chosen, shares = langid.mixture(1000 * chance @ [0.6, 0.4], chance)
    assert dict(zip(chosen, shares.round(2))) == {0: 0.6, 1: 0.4}
    assert langid.mixture(1000 * chance[:, 0], chance)[0] == [0]


def test_more_than_four_languages():
    chance = np.full((6, 6), 0.02) + 0.88 * np.eye(6)
    chosen, shares = langid.mixture(6000 * chance.mean(axis=1), chance)
    assert sorted(chosen) == list(range(6)) and np.allclose(shares, 1 / 6, atol=0.01)


def every_subset(counts, chance):
    """The set of languages with the largest penalised likelihood, each set fitted on its own."""
    found = []
    for size in range(1, chance.shape[1] + 1):
        for chosen in itertools.combinations(range(chance.shape[1]), size):
            p, s = chance[:, chosen], np.full(size, 1 / size)
            for _ in range(400):
                part = p * s
                s = (counts / part.sum(axis=1)) @ part / counts.sum()
            found.append((counts @ np.log(p @ s) - (size - 1) * langid.PENALTY * np.log(counts.sum()) / 2, chosen))
    return set(max(found)[1])


def test_sets_like_every_subset():
    rng = np.random.default_rng(11)
    for _ in range(25):
        chance = rng.dirichlet(np.full(60, 0.5), size=5).T + 1e-5
        chance /= chance.sum(axis=0)
        real = rng.choice(5, size=rng.integers(1, 4), replace=False)
        counts = rng.multinomial(4000, chance[:, real] @ rng.dirichlet(np.full(len(real), 5.0))).astype(float)
        assert set(langid.mixture(counts, chance)[0]) == every_subset(counts, chance)


def test_long_and_repeated_texts_beside_clashing_columns(spark, learned):
    """A text of megabytes counts whole: its end turns the language.  Equal rows get equal results."""
    docs = {r["lang"]: r["text"] for r in spark.read.parquet(f"{ROOT}/documents.parquet").where(
        "n_chars > 3000").collect()}
    head, tail = docs["de"][:3000], (docs["es"][:3000] + " ") * 700
    rows = [(1, head + " " + tail), (2, docs["de"]), (2, docs["de"]), (3, head)]
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows],
                                  "doc_id long, text string, lang_pred string, score string, mixture string")
    got = sorted((r["doc_id"], r["g"]["lang_pred"], r["g"]["score"]) for r in frame.select(
        "doc_id", langid.guess(learned, frame["text"]).alias("g")).collect())
    assert [g[:2] for g in got] == [(1, "es"), (2, "de"), (2, "de"), (3, "de")]
    assert got[1] == got[2] and got[0][2] > 0.95


def test_odd_rows(odd, empty, learned):
    got = guesses(odd, learned)
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (3, 4, 5, 7))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    nothing = langid.learn(empty)
    assert guesses(empty, nothing) == {} and guesses(odd, nothing)[1]["lang_pred"] == "und"


def test_predicting_needs_no_large_table(spark, monkeypatch):
    """The table of places is written where a known trigram lies only, and holds two bytes a trigram."""
    made, zeros, full = [], np.zeros, np.full
    text = "the quick brown fox jumps over the lazy dog "
    codes = np.unique(langid.trigrams(text))
    model = langid.Model(codes, np.full((len(codes), 2), 1 / len(codes)), ("a", "b"), np.array([0.6, 0.4]))
    kept = lambda a: made.append(a.nbytes) or a
    monkeypatch.setattr(np, "zeros", lambda *a, **k: kept(zeros(*a, **k)))
    monkeypatch.setattr(np, "full", lambda *a, **k: kept(full(*a, **k)))
    found = list(langid.classifier(model).func(iter([pd.Series([text, None, "1 2"])])))[0]
    assert list(found["lang_pred"]) == ["a", "und", "und"]
    assert max(made) == 2 << 24
