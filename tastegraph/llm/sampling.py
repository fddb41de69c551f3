"""Bounded samples of labelled and unlabelled texts for fitting classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chance(doc_id: Column, salt: int) -> Column:
    """A number in [0, 1) by the id alone."""
    return F.pmod(F.xxhash64(doc_id, F.lit(salt)), F.lit(1 << 20)).cast("double") / (1 << 20)


def labelled(docs: DataFrame, labels: DataFrame, column: str, may_learn: Column, per_class: int) -> DataFrame:
    """``(doc_id, text, y)``: about ``per_class`` documents of each label at most, chosen by hash of the id.

    ``labels`` has doc_id and ``column`` (0, 1 or null); ids with contradicting labels are
    left out.  The ids broadcast are bounded by ``per_class``, whatever the size of the tables.
    """
    known = (labels.where(F.col(column).isNotNull() & may_learn).groupBy("doc_id")
             .agg(F.min(column).alias("y"), F.max(column).alias("_most"))
             .where(F.col("y") == F.col("_most")).select("doc_id", F.col("y").cast("int").alias("y")))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return docs.sparkSession.createDataFrame([], "doc_id long, text string, y int")
    share = F.coalesce(*[F.when(F.col("y") == y, F.lit(per_class / n)) for y, n in sizes.items()])
    ids = known.where(chance(F.col("doc_id"), 3) < share)
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")


def sparse(texts: DataFrame, features: Callable[[], Callable[[str], np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels and distinct feature numbers of rows ``(doc_id, text, y)``, in order of the id.

    ``features()`` runs once per task and gives a function from a text to its features.
    """

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = features()
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "y": batch["y"],
                                "f": [of(t or "").astype("<u4").tobytes() for t in batch["text"]]})

    rows = texts.select(F.col("doc_id").cast("long"), "text", "y").mapInPandas(
        extract, "doc_id long, y int, f binary").toPandas().sort_values("doc_id", kind="stable")
    return rows["y"].to_numpy(np.int64), [np.frombuffer(f, "<u4").astype(np.int64) for f in rows["f"]]


class Rows:
    """Sparse rows of ones, or of one value per feature: products with a weight vector."""

    def __init__(self, features: list[np.ndarray], width: int):
        self.n, self.width = len(features), width
        sizes = np.array([len(f) for f in features], np.int64)
        self.row = np.repeat(np.arange(self.n), sizes)
        self.col = np.concatenate(features) if self.n else np.empty(0, np.int64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, g[self.row], self.width)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
