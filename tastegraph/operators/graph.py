"""Name graphs: edges from adjacency lines, connected components, clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import literal_pattern
from ..session import materialize
from .ranking import chunked_lists


def adjacency_edges(lines: DataFrame, sep: str = ",") -> DataFrame:
    """``(src, dst)``: the first name of a line to every name of it; blanks dropped."""
    return _adjacent(lines, sep).distinct()


def _adjacent(lines: DataFrame, sep: str) -> DataFrame:
    """The same with repeats."""
    names = F.filter(F.split("value", literal_pattern(sep), -1), lambda n: n != "")
    # as the output of a generator the names are split once
    named = lines.select(F.explode(F.array(names)).alias("names")).where(F.size("names") > 0)
    return named.select(F.col("names")[0].alias("src"), F.explode("names").alias("dst"))


def line_components(lines: DataFrame, sep: str = ",") -> DataFrame:
    """``(vertex, component)`` of the names of adjacency lines."""
    return components(_adjacent(lines, sep))


def components(edges: DataFrame) -> DataFrame:
    """``(vertex, component)``: the least vertex (a number or a name) of the connected component.

    Alternating large-star and small-star rounds (Kiveris et al. 2014).  The
    minimum of a neighbourhood is an aggregation joined back to the edges, so a
    hub is never gathered in one place; rounds are cut by written tables.  A
    component leaves the rounds as soon as it is a star around its least vertex, so
    only what is still open is moved again.
    """
    both = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    links = materialize(both.distinct(), "edges")
    ends = _ends(links)
    labels = ends.where("n = 0").select(F.col("u").alias("vertex"), F.col("u").alias("component"))
    links = links.where("src > dst")
    while True:
        finished = materialize(_finished(ends), "components")
        labels = labels.unionByName(finished)
        centers = finished.where("vertex = component").select(F.col("vertex").alias("dst"))
        links = materialize(_small_star(_large_star(links.join(centers, "dst", "left_anti"))), "edges")
        if links.isEmpty():
            return labels
        ends = _ends(links)


def name_components(edges: DataFrame) -> DataFrame:
    """The same for names, which are compared as they are."""
    return components(edges)


def _ends(links: DataFrame) -> DataFrame:
    """``(u, n, low)`` per vertex: how many other vertices it is linked with, and the least of them and itself."""
    both = links.select(F.explode(F.array(
        F.struct(F.col("src").alias("u"), F.col("dst").alias("v")),
        F.struct(F.col("dst").alias("u"), F.col("src").alias("v")))).alias("e")).select("e.*")
    return both.groupBy("u").agg(F.count(F.when(F.col("u") != F.col("v"), 1)).alias("n"), F.least("u", F.min("v")).alias("low"))


def _finished(ends: DataFrame) -> DataFrame:
    """``(vertex, component)`` of stars: every neighbour of the least vertex is linked with nothing else."""
    leaf = (F.col("n") == 1) & (F.col("low") < F.col("u"))
    own = ends.where(leaf | ((F.col("low") == F.col("u")) & (F.col("n") > 0)))
    stars = own.groupBy(F.col("low").alias("component")).agg(
        F.count(F.when(leaf, 1)).alias("leaves"), F.max(F.when(~leaf, F.col("n"))).alias("linked")).where("leaves = linked")
    return own.select(F.col("u").alias("vertex"), F.col("low").alias("component")).join(stars.select("component"), "component").select(
        "vertex", "component")


def _large_star(links: DataFrame) -> DataFrame:
    """Connect every larger neighbour of u to the least vertex around u."""
    both = links.select(F.explode(F.array(
        F.struct(F.col("src").alias("u"), F.col("dst").alias("v")),
        F.struct(F.col("dst").alias("u"), F.col("src").alias("v")))).alias("e")).select("e.*")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(
        F.col("v").alias("src"), F.col("m").alias("dst")).where(F.col("src") != F.col("dst"))


def _small_star(links: DataFrame) -> DataFrame:
    """Connect u and its smaller neighbours to the least of them."""
    down = links.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("src"), F.col("m").alias("dst"))
    own = least.select(F.col("u").alias("src"), F.col("m").alias("dst"))
    return moved.unionByName(own).where(F.col("src") != F.col("dst")).distinct()


def clusters(lines: DataFrame, sep: str = ",", chunk: int = 1000) -> DataFrame:
    """``(component, part, names, n)``: sorted names per component.

    A component of more than ``chunk`` names is spread over several rows.
    """
    labelled = line_components(lines, sep)
    lists = chunked_lists(labelled, "component", "vertex", chunk)
    return lists.select("component", "part", F.array_join("values", ",").alias("names"), "n")
