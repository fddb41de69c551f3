"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order of nearness.  Each shard of the index
keeps, per pivot, the vectors that have it among their nearest, with its place (a pivot
inverted file).  A query reads the files of its own nearest pivots, ranks the vectors of the shard by
footrule distance (the sum of how far places differ; a pivot that is missing stands at the end),
and the best part, with all that is tied with its last, is ranked again by the true cosine.

Pivots stand apart from each other: of vectors closer than ``APART`` only one becomes a pivot, or a dense group
would fill the places of all others with its own pivots.  Where a pivot is crowded (many of the sample were that close to it),
those others are its local pivots: inside its cell, what distinguishes vectors is the way they differ from the
pivot, so a query of the cell also ranks the cell by permutations of these differences, and the best part of both is ranked again.

Equal vectors are indexed once, with the least ids among them, and expanded after the search.
Shards are blocks of distinct vectors of about the same size however large the table, so a shard fits a task and
recall depends neither on the number of rows nor on copies; queries pass in blocks.  Best lists of the shards are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.ranking import top_k
from ..session import materialize
from .common import read

#: Pivots (of a sample by hash of the vector; what is broadcast), and how many of them represent a vector.
PIVOTS, NEAREST = 256, 64
#: Vectors of the sample, the cosine above which two are no two pivots, and the least and greatest number of local pivots.
DRAWN, APART, LOCAL = 2048, 0.9, (32, 128)
#: Distinct vectors of a shard and queries of a block (expected).
SHARD, BLOCK = 8192, 1024
#: Part of a shard that is ranked again, and the least number.
RERANK, LEAST = 0.15, 200
TOP = 5
EVERY = 50
#: Parts in which the ids of one vector are ranked first, so that many copies are no single task's work.
PARTS = 16


def usable(vectors: DataFrame) -> DataFrame:
    """Rows ``(vec_id, vector)``: null ids or vectors, null or non-finite components and zero vectors are out."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long"), v.alias("vector"), fine.alias("_fine")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.col("_fine"))
    return rows.where(F.exists("vector", lambda x: x != 0)).select("vec_id", "vector")


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; by their largest component first, so nothing overflows."""
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / np.where(largest > 0, largest, 1.0)
    return scaled / np.maximum(np.sqrt((scaled * scaled).sum(axis=1, keepdims=True)), 1e-300)


def pivot_sample(distinct: DataFrame, pivots: int = PIVOTS) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Up to ``pivots`` unit vectors that stand apart, and the local pivots of crowded ones.

    Taken in order from the ``DRAWN`` rows with the least hash of their vector; ``distinct`` holds each vector once.
    """
    picked = distinct.select("vector").orderBy(F.xxhash64("vector", F.lit(10)), "vector").limit(max(DRAWN, pivots)).toPandas()
    if not len(picked):
        return np.empty((0, 0)), {}
    sample = unit(np.array(picked["vector"].tolist(), float))
    chosen = np.empty((0, sample.shape[1]))
    close: dict[int, list[np.ndarray]] = {}
    for v in sample:
        near = chosen @ v
        if len(near) and near.max() > APART:
            close.setdefault(int(near.argmax()), []).append(v)
        elif len(chosen) < pivots:
            chosen = np.vstack([chosen, v])
    local = {cell: unit(np.array(own[:LOCAL[1]]) - chosen[cell]) for cell, own in close.items() if len(own) >= LOCAL[0]}
    return chosen, local


def places(units: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """(rows, nearest) pivots, the nearest first."""
    near = units @ pivots.T
    nearest = min(nearest, len(pivots))
    some = np.argpartition(-near, nearest - 1, axis=1)[:, :nearest]
    order = np.argsort(-np.take_along_axis(near, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1)


def distinct_vectors(rows: DataFrame, least: int) -> DataFrame:
    """``(vec_id, vector, ids)`` of rows ``(vec_id, vector)``: each vector once, its least id, and its ``least`` least ids."""
    part = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(PARTS))
    some = top_k(rows.withColumn("_part", part), ["vector", "_part"], [F.col("vec_id")], least)
    ids = F.slice(F.sort_array(F.collect_list("vec_id")), 1, least)
    return some.groupBy("vector").agg(ids.alias("ids")).select(F.col("ids")[0].alias("vec_id"), "vector", "ids")


def cells_of(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The nearest pivot of each row, -1 if it is not closer than ``APART``."""
    near = units @ pivots.T
    best = near.argmax(axis=1)
    return np.where(near[np.arange(len(units)), best] > APART, best, -1)


def nearest_part(distance: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` least distances and of all that are tied with the last."""
    most = min(most, len(distance))
    return np.flatnonzero(distance <= np.partition(distance, most - 1)[most - 1])


class Shard:
    """Pivot inverted files of some vectors; ``copies`` are the ids of each one (its own id if left out)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, nearest: int,
                 copies: list[np.ndarray] | None = None, local: dict[int, np.ndarray] | None = None):
        order = np.argsort(ids, kind="stable")
        self.ids, self.units, self.pivots = ids[order], unit(vectors[order]), pivots
        self.copies = [ids[i:i + 1] if copies is None else copies[i] for i in order]
        self.single = np.array([len(c) == 1 for c in self.copies], bool)
        own = places(self.units, pivots, nearest)
        self.depth = own.shape[1]
        flat = own.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        self.row = (by_pivot // self.depth).astype(np.int64)
        self.place = (by_pivot % self.depth).astype(np.float64)
        self.begin = np.searchsorted(flat[by_pivot], np.arange(len(pivots) + 1))
        self.cells = {}
        cell = cells_of(self.units, pivots) if local else own[:0, 0]
        for c, own_pivots in (local or {}).items():
            members = np.flatnonzero(cell == c)
            if len(members):
                inner = Shard(np.arange(len(members)), self.units[members] - pivots[c], own_pivots, nearest)
                self.cells[c] = members, inner

    def footrule(self, query: np.ndarray) -> np.ndarray:
        """Distance of every vector from a query's ordered pivots.

        Without a shared pivot it is twice the sum of all places' distances from the end; each
        shared one replaces its two parts by the difference of places.
        """
        total = np.full(len(self.ids), float(self.depth * (self.depth + 1)))
        for at, pivot in enumerate(query):
            part = slice(self.begin[pivot], self.begin[pivot + 1])
            there = self.place[part]  # a vector stands once in a file
            total[self.row[part]] += np.abs(there - at) - (self.depth - there) - (self.depth - at)
        return total

    def search(self, query_ids: np.ndarray, queries: np.ndarray, top: int, rerank: int) -> Iterator[tuple]:
        """Rows ``(query_id, vec_id, score)``, the ``top`` of this shard for each query."""
        units = unit(queries)
        for query_id, q, near in zip(query_ids, units, places(units, self.pivots, self.depth)):
            distance = self.footrule(near)
            own = (self.ids == query_id) & self.single
            some = nearest_part(distance, rerank)
            if self.cells and (cell := int(cells_of(q[None], self.pivots)[0])) in self.cells:
                members, inner = self.cells[cell]
                within = inner.footrule(places(unit(q[None] - self.pivots[cell]), inner.pivots, inner.depth)[0])
                some = np.union1d(some, members[nearest_part(within, max(LEAST, rerank * len(members) // len(self.ids)))])
            some = some[~own[some]]
            if not len(some):
                continue
            score = np.minimum(1.0, np.maximum(-1.0, (self.units[some] * q).sum(axis=1)))
            if len(some) > top + 1:  # one of the best may hold no id but the query's
                good = score >= np.partition(score, -top - 1)[-top - 1]
                some, score = some[good], score[good]
            score = np.repeat(score, [len(self.copies[i]) for i in some])
            ids = np.concatenate([self.copies[i] for i in some])
            ids, score = ids[ids != query_id], score[ids != query_id]
            best = np.lexsort((ids, -score))[:top]
            yield from zip([query_id] * len(best), ids[best], score[best])


def neighbours(vectors: DataFrame, queries: DataFrame, top: int = TOP, pivots: int = PIVOTS,
               nearest: int = NEAREST, shard: int = SHARD, rerank: float = RERANK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``top`` nearest rows of ``vectors`` for each of ``queries``.

    Both have vec_id and embedding of one length; a query's own id is no candidate.  Rows with a null, zero
    or non-finite vector take no part, repeated ids are one vector (the least).  Equal scores go by
    vec_id, copies of one vector too.  With few rows everything is ranked again and the result is exact.
    """
    rows = usable(vectors).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    distinct = materialize(distinct_vectors(rows, top + 1), "vectors")
    asked = materialize(usable(queries).groupBy("vec_id").agg(F.min("vector").alias("vector")), "queries")
    n, q = distinct.count(), asked.count()
    shards, blocks = -(-n // shard) or 1, -(-q // BLOCK) or 1
    chosen, local = pivot_sample(distinct, pivots)
    index = distinct.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int"))
    probes = (asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int"))
              .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    parts = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            own = Shard(left["vec_id"].to_numpy(np.int64), np.array(left["vector"].tolist(), float), chosen, nearest,
                        [np.asarray(x, np.int64) for x in left["ids"]], local)
            found = list(own.search(right["vec_id"].to_numpy(np.int64), np.array(right["vector"].tolist(), float),
                                    top, max(LEAST, int(rerank * len(left)))))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    best = parts.groupBy("shard", "block").cogroup(probes.groupBy("shard", "block")).applyInPandas(
        search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return neighbours(vectors, vectors.where(F.pmod("vec_id", F.lit(EVERY)) == 0))
