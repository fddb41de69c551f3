"""Quality by naive Bayes support vectors.

Indicators of n-grams are scaled by the log ratio of their smoothed counts in both classes; a linear model with
hinge loss is then fitted by dual coordinate descent.  The n-grams run over the
shapes of words (case, digits, marks, and whether the word repeats the one before), which
tell noise from prose in any language.
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

#: Documents per label the classifier is fitted on (expected number).
SAMPLE = 5000
HASHED = 1 << 18
THRESHOLD = 0.7
#: Share of an n-gram's own weight in its final one; the rest is the mean size of all weights.
SMOOTH = 0.25
CACHED_WORDS = 300_000
#: A token of more characters (unspaced script, words joined by marks) is cut, so that all of it is seen.
LONG, PARTS = 40, re.compile(r"\w{1,12}|[^\w]+")
RUNS = ((re.compile(r"[^\W\d_]{2,}"), lambda m: "AA" if m[0].isupper() else "Aa" if m[0][0].isupper() else "a"),
        (re.compile(r"\d+"), lambda m: "0"), (re.compile(r"([^\w])\1{2,}"), lambda m: m[1] * 3))


def shape(word: str) -> int:
    for pattern, short in RUNS:
        word = pattern.sub(short, word)
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


def cut_words(text: str) -> list[str]:
    """Tokens between white space; longer ones than ``LONG`` are cut into marks and up to 12 letters each."""
    words = text.split()
    if not any(len(w) > LONG for w in set(words)):
        return words
    return [part for w in words for part in ([w] if len(w) <= LONG else PARTS.findall(w))]


def ngrams():
    """A function from a text to the numbers of its shape n-grams of one to three words."""
    numbers: dict[str, int] = {}
    shapes: list[int] = []

    def of(text: str) -> np.ndarray:
        words = cut_words(text)
        if len(numbers) > CACHED_WORDS:
            numbers.clear()
            shapes.clear()
        for w in set(words):
            if w not in numbers:
                numbers[w] = len(shapes)
                shapes.append(shape(w))
        if not words:
            return np.empty(0, np.uint32)
        ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        used, at = np.unique(ids, return_inverse=True)
        s = np.array([shapes[i] for i in used], np.uint64)[at] << np.uint64(1)
        s[1:] |= (ids[1:] == ids[:-1]).astype(np.uint64)
        mix = np.uint64(0x9E3779B97F4A7C15)
        grams = [s * mix]
        for _ in range(2):
            grams.append((grams[-1][:-1] ^ (grams[-1][:-1] >> np.uint64(29))) * mix + s[len(grams):] * mix)
        return np.unique(np.concatenate([(g >> np.uint64(40)) % np.uint64(HASHED) for g in grams])).astype(np.uint32)

    return of


@dataclass(frozen=True)
class Model:
    """Weight per hashed n-gram, intercept, and the line from margin to log-odds."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def descend(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: float = 1.0,
            rounds: int = 20, seed: int = 6) -> np.ndarray:
    """Weights (the last is the intercept) of the linear hinge-loss model, by dual coordinate descent."""
    w, alpha = np.zeros(len(scale) + 1), np.zeros(len(rows))
    square = np.array([(scale[f] ** 2).sum() + 1 for f in rows])
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            f, x = rows[i], scale[rows[i]]
            slope = y[i] * (w[f] @ x + w[-1]) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), cost)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[f] += step * x
                w[-1] += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w


def ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Log ratio of each n-gram's smoothed share among good and bad documents; 0 for one never seen."""
    side = [np.bincount(np.concatenate([*[f for f, k in zip(rows, y) if k == s], np.empty(0, np.int64)]),
                        minlength=HASHED) + 1.0 for s in (1, -1)]
    ratio = np.log(side[0] / side[0].sum()) - np.log(side[1] / side[1].sum())
    return np.where(side[0] + side[1] > 2, ratio, 0.0)


def train(labels: np.ndarray, rows: list[np.ndarray]) -> Model:
    """With one class only (or none) every text gets the share of good ones (or one half)."""
    y = np.where(labels == 1, 1, -1)
    good = (y == 1).mean() if len(y) else 0.5
    if not 0 < good < 1:
        return Model(np.zeros(HASHED), 0.0, 0.0, float(np.log((good + 0.05) / (1.05 - good))))

    def fitted(part: np.ndarray) -> tuple[np.ndarray, float]:
        own = [rows[i] for i in part]
        r = ratios(own, y[part])
        w = descend(own, r, y[part])
        mean = np.abs(w[:-1][r != 0]).sum() / max(1, np.count_nonzero(r))
        return r * ((1 - SMOOTH) * mean + SMOOTH * w[:-1]), w[-1]

    # margins of documents the weights were not fitted on show how sure a margin makes us
    margins = np.zeros(len(y))
    for fold in range(2):
        here = np.arange(len(y)) % 2 == fold
        if len(set(y[~here])) < 2:
            continue
        w, b = fitted(np.flatnonzero(~here))
        margins[here] = [w[rows[i]].sum() + b for i in np.flatnonzero(here)]
    slope, shift = platt(margins, (y == 1).astype(float))
    w, b = fitted(np.arange(len(y)))
    return Model(w, float(b), slope, shift)


def platt(margins: np.ndarray, good: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Line from margin to log-odds by Newton steps, with targets drawn in as Platt does."""
    n1, n0 = good.sum(), len(good) - good.sum()
    goal = np.where(good == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones_like(margins)])
    line = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = sampling.sigmoid(line @ x)
        grad = x @ (p - goal)
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2), grad)
        line = line - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return float(line[0]), float(line[1])


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """From rows of ``labels(doc_id, quality)`` that may be learned from, and the texts they name."""
    return train(*sampling.sparse(sampling.labelled(
        docs, labels, "quality", id_mod(F.col("doc_id"), 4) != 2, SAMPLE), ngrams))


def scorer(model: Model):
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = ngrams()
        for texts in batches:
            margins = np.array([model.weights[of(t or "")].sum() for t in texts], float) + model.bias
            yield pd.Series(sampling.sigmoid(model.slope * margins + model.shift))

    return score


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts; a null text counts as an empty one: no n-gram, the intercept alone."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    score = scorer(learn(docs, read(spark, sf_dir, "labels", "doc_id", "quality")))
    return docs.select("doc_id", (id_mod(F.col("doc_id"), 4) == 2).alias("held_out"),
                       score(F.col("text")).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
