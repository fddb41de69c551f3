"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents are taken as labelled; all other text is unlabelled and
holds an unknown part of toxic documents, whose share is the class prior.  The risk of
calling unlabelled text clean is corrected by what toxic documents contribute to it, and that
corrected part is kept from falling below 0: where it does, the step goes the other way.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sampling
from .common import id_mod, read

#: Toxic documents and unlabelled documents the classifier is fitted on (expected numbers).
POSITIVES, UNLABELLED = 4000, 12000
HASHED = 1 << 20
#: Features kept of all hashed ones.
KEPT = 3000
#: A feature must occur in this share of the toxic sample, so that a few copies of one text don't make it.
MIN_SHARE = 0.005
THRESHOLD = 0.7
CACHED_WORDS = 300_000
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
INNER = re.compile(r"[\W_]+")


def word_features(token: str) -> list[int]:
    """Of a token, hashed: the whole, and of each run of letters in it the word and its beginnings of four to seven letters.

    Runs in a script without case (most of those that don't put spaces between words) also give all their
    two and three neighbouring characters.
    """
    whole = EDGES.sub("", token.lower())
    names = {f"={whole}"} if whole else set()
    for word in INNER.split(whole):
        if word:
            names.update([f"={word}", *[f"^{word[:k]}" for k in (4, 5, 6, 7) if len(word) >= k]])
            if not word.isascii() and word.upper() == word:
                names.update(f"~{word[i:i + k]}" for k in (2, 3) for i in range(len(word) - k + 1))
    return [zlib.crc32(n.encode("utf-8", "surrogatepass")) % HASHED for n in names]


class Known(dict):
    """Token to what ``find`` gives, kept for ``CACHED_WORDS`` tokens."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, token: str):
        if len(self) > CACHED_WORDS:
            self.clear()
        self[token] = got = self.find(token)
        return got


def all_features():
    known = Known(word_features)

    def of(text: str) -> np.ndarray:
        return np.array(sorted({f for t in set(text.split()) for f in known[t]}), np.uint32)
    return of


@dataclass(frozen=True)
class Model:
    """Weights of the kept features by their hashed number, and the intercept."""

    weights: dict[int, float]
    bias: float


def choose(positive: list[np.ndarray], unlabelled: list[np.ndarray], kept: int = KEPT) -> np.ndarray:
    """Features whose share of toxic documents stands out most from their share of all text."""
    p = np.bincount(np.concatenate([*positive, np.empty(0, np.int64)]), minlength=HASHED)
    u = np.bincount(np.concatenate([*unlabelled, np.empty(0, np.int64)]), minlength=HASHED)
    np_, nu = max(1, len(positive)), max(1, len(unlabelled))
    rate = (p + u + 1) / (np_ + nu + 2)
    z = np.abs(p / np_ - u / nu) / np.sqrt(rate * (1 - rate) * (1 / np_ + 1 / nu))
    order = np.argsort(-z, kind="stable")
    return order[(z[order] > 3) & (p[order] >= max(3, MIN_SHARE * np_))][:kept]


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, rounds: int = 400,
          rate: float = 0.05, decay: float = 1e-4) -> Model:
    """Logistic loss, full batches, Adam steps.  Without toxic documents: the prior for all texts."""
    prior = min(max(prior, 1e-3), 0.9)
    base = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return Model({}, base if positive else float(np.log(1e-3)))
    chosen = np.sort(choose(positive, unlabelled))
    at = np.full(HASHED, -1, np.int64)
    at[chosen] = np.arange(len(chosen))
    p, u = (sampling.Rows([at[f][at[f] >= 0] for f in rows], len(chosen)) for rows in (positive, unlabelled))
    w = np.zeros(len(chosen) + 1)
    w[-1] = base
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        zp, zu = p.dot(w[:-1]) + w[-1], u.dot(w[:-1]) + w[-1]
        # derivative of log(1 + e^-z) is -s(-z), of log(1 + e^z) is s(z)
        toxic = -sampling.sigmoid(-zp) * prior / p.n
        clean_u, clean_p = sampling.sigmoid(zu) / u.n, sampling.sigmoid(zp) * prior / p.n
        risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        if risk >= 0:
            gp, gu = toxic - clean_p, clean_u
        else:
            gp, gu = clean_p, -clean_u
        grad = np.append(p.back(gp) + u.back(gu), gp.sum() + gu.sum())
        grad[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model({int(f): float(x) for f, x in zip(chosen, w)}, float(w[-1]))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Toxic rows of ``labels(doc_id, toxic)`` that may be learned from, and any text of ``docs``.

    The class prior is the share of toxic ones among the labels that may be learned from.
    """
    may = id_mod(F.col("doc_id"), 3) != 1
    usable = labels.select("doc_id", "toxic").where(may & F.col("toxic").isNotNull())
    count = usable.agg(F.avg(F.col("toxic").cast("double")).alias("prior")).first()
    toxic = sampling.labelled(docs, usable.where(F.col("toxic") == 1), "toxic", F.lit(True), POSITIVES)
    _, positive = sampling.sparse(toxic, all_features)
    texts = docs.select("doc_id", "text", F.lit(0).alias("y"))
    n = texts.count()
    _, unlabelled = sampling.sparse(
        texts.where(sampling.chance(F.col("doc_id"), 4) < UNLABELLED / max(n, 1)), all_features)
    return train(positive, unlabelled, count["prior"] or 0.0)


def scorer(model: Model):
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Known(lambda token: tuple(f for f in word_features(token) if f in model.weights))
        none = sampling.sigmoid(np.array(model.bias)).item()

        def one(text: str | None) -> float:
            found = {f for t in set((text or "").split()) for f in known[t]}
            return float(sampling.sigmoid(np.array(model.bias + sum(model.weights[f] for f in sorted(found))))) \
                if found else none

        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype="float64")

    return score


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts; a null text counts as an empty one and gets the score of no evidence."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    score = scorer(learn(docs, read(spark, sf_dir, "labels", "doc_id", "toxic")))
    return docs.select("doc_id", (id_mod(F.col("doc_id"), 3) == 1).alias("held_out"),
                       score(F.col("text")).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
