"""Language identification by multilingual mixture inference.

A document is taken as a bag of byte trigrams drawn from a mixture of languages.  For a set of
languages, expectation-maximisation finds the shares under which the trigrams are
likeliest.  The set starts with the best single language and grows by the
language that adds most, as long as the gain is worth its penalty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_mod, read

#: Documents per language that the model is fitted on (expected number, chosen by hash of the id).
SAMPLE = 4000
#: Trigrams with at least this share of a language's trigrams are known: at most 10,000 a language.
MIN_SHARE = 1e-4
#: Weight of ``log(n) / 2`` for each further language; neighbouring trigrams share bytes, hence 3.
PENALTY = 3.0
#: Texts whose trigrams a task holds at once.
AT_ONCE = 128
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """Known trigram codes in order, their probability per language, and the languages by prior."""

    codes: np.ndarray
    chance: np.ndarray
    languages: tuple[str, ...]
    prior: np.ndarray


def trigrams(text: str) -> np.ndarray:
    """Codes of all byte trigrams of the text in lower case."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.int32)
    return raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16 if len(raw) > 2 else np.empty(0, np.int32)


def fit(labelled: DataFrame, sample: int = SAMPLE, min_share: float = MIN_SHARE) -> Model:
    """Learn from rows ``(doc_id, text, lang)``; rows with a null text or lang are left out.

    Counts are taken by the tasks and summed by Spark; the driver gets the known trigrams only.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Model(np.empty(0, np.int32), np.empty((0, 0)), (), np.empty(0))
    keep = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 20)).cast("double") / (1 << 20)
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(sample / n)) for k, n in sizes.items()])

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                for at in range(0, len(texts), AT_ONCE):
                    code, n = np.unique(np.concatenate([trigrams(t) for t in texts.iloc[at:at + AT_ONCE]]), return_counts=True)
                    yield pd.DataFrame({"lang": lang, "code": code, "n": n})

    counts = (rows.where(keep < share).select("lang", "text").mapInPandas(counted, "lang string, code int, n long")
              .groupBy("lang", "code").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    known = counts.join(totals, "lang").where(F.col("n") >= min_share * F.col("total")).select(
        "lang", "code", "n", "total").toPandas()
    languages = tuple(sorted(sizes, key=lambda k: (-sizes[k], k)))
    codes = np.unique(known["code"].to_numpy(np.int32))
    counts_of = np.zeros((len(codes), len(languages)))
    counts_of[np.searchsorted(codes, known["code"].to_numpy(np.int32)),
              known["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy(np.int64)] = known["n"]
    total = np.ones(len(languages))
    for lang, n in known.groupby("lang")["total"].first().items():
        total[languages.index(lang)] = n
    # a trigram below the share in one language but known in another gets half the least count
    chance = np.maximum(counts_of, min_share * total / 2) / total
    prior = np.array([sizes[k] for k in languages], float)
    return Model(codes, chance / chance.sum(axis=0), languages, prior / prior.sum())


def mixture(counts: np.ndarray, chance: np.ndarray, penalty: float = PENALTY,
            rounds: int = 30) -> tuple[list[int], np.ndarray]:
    """Languages and shares for ``counts`` of trigrams whose chances per language are given.

    Only the penalty ends the growth of the set, at the latest when all languages are in it.
    """
    n = counts.sum()
    single = counts @ np.log(chance)
    chosen = [int(single.argmax())]
    shares, best = np.ones(1), single.max()
    while len(chosen) < chance.shape[1]:
        # the likelihood is concave: a language whose share gains nothing at 0 never gains
        slope = (counts / (chance[:, chosen] @ shares)) @ chance / n
        tried = None
        for k in np.flatnonzero(slope > 1 + 1e-9):
            if k in chosen:
                continue
            p = chance[:, [*chosen, k]]
            s = np.append(shares * 0.8, 0.2)
            for _ in range(rounds):
                part = p * s
                new = (counts / part.sum(axis=1)) @ part / n
                done = np.abs(new - s).max() < 1e-4
                s = new
                if done:
                    break
            found = counts @ np.log(p @ s)
            if tried is None or found > tried[0]:
                tried = found, int(k), s
        if tried is None or tried[0] - best <= penalty * np.log(n) / 2:
            break
        best, k, shares = tried
        chosen.append(k)
    return chosen, shares


def classifier(model: Model):
    """Pandas UDF from text to ``(lang_pred, score, mixture)``."""

    @F.pandas_udf("lang_pred string, score double, mixture string")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        # 0 is unknown: pages without a known trigram are never written, so they take no memory
        place = np.zeros(1 << 24, np.uint16 if len(model.codes) < 1 << 16 else np.int32)
        place[model.codes] = np.arange(1, len(model.codes) + 1, dtype=place.dtype)
        top = int(model.prior.argmax()) if model.languages else -1

        def one(text: str | None) -> tuple[str, float, str]:
            if text is None or top < 0 or not any(map(str.isalpha, text)):
                return UNKNOWN, 0.0, ""
            at = place[trigrams(text)]
            counts = np.bincount(at, minlength=len(model.codes) + 1)[1:]
            seen = np.flatnonzero(counts)
            if not len(seen):
                return model.languages[top], float(model.prior[top]), ""
            chosen, shares = mixture(counts[seen].astype(float), model.chance[seen])
            order = np.argsort(-shares, kind="stable")
            return (model.languages[chosen[order[0]]], float(min(1.0, shares[order[0]])),
                    " ".join(f"{model.languages[chosen[i]]}:{shares[i]:.3f}" for i in order))

        for texts in batches:
            yield pd.DataFrame([one(t) for t in texts], columns=["lang_pred", "score", "mixture"])

    return predict


def learn(docs: DataFrame) -> Model:
    """The model of all documents but those held out."""
    return fit(docs.where(id_mod(F.col("doc_id"), 5) != 0))


def guess(model: Model, text: Column) -> Column:
    """Struct of ``lang_pred``, ``score`` (share of that language, 0 to 1) and ``mixture``.

    A null text, one without a letter, or a model that learned nothing gives ``und`` and 0.
    Letters but no known trigram: the most frequent language, with its prior as the score.
    """
    return classifier(model)(text)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return docs.select("doc_id", (id_mod(F.col("doc_id"), 5) == 0).alias("held_out"),
                       guess(learn(docs), F.col("text")).alias("g")).select("doc_id", "held_out", "g.*")
