"""Near-duplicates by a chosen-path set similarity join.

A document is the set of its word shingles.  Documents walk down random trees: a node names one or two
places of the minwise signature, and a document goes on to a child by the token it has
there, so similar documents tend to take the same way.  A node with few documents is compared
exhaustively on full sets; a larger one branches further.  Independent trees are
repeated until a pair at the threshold is missed with a probability of at most ``1 - RECALL``, at whatever
depth it has to be found; deeper nodes are met more seldom and need more trees (:func:`trees_for`).

What keeps hot groups cheap:

* Equal sets are one class from the start and walk once.
* Links found become components before the trees are followed further.  Only documents of different
  components are compared, and a node inside one component is not visited.
* A first round deals large nodes at random into small parts, which ties a large group of
  near copies together without pairing it.  What stands beside such a group in a node visits
  every part of it; the group itself is not paired.
* Only a node too mixed for that to stay linear is followed deeper.
* Signatures are compared first, and texts are made into sets only where those of two components come near.

So no task holds more than two parts of ``SMALL`` documents, and nothing is dropped.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import components
from ..session import materialize
from .common import read

SHINGLE = 3
PERCENT = 85
#: Places of a signature; a node is compared exhaustively up to so many documents.
PLACES, SMALL = 64, 256
#: Trees of the first round, which only deals large nodes into parts, and the least number of the others.
DEALING, LEAST = 4, 8
#: Share of pairs at the threshold that meet in a node of the last round; what may be missed is shared by the depths.
RECALL = 0.99
#: Depths at which nodes are looked at.
DEPTHS = (3, 6, 12)
#: A node is compared whole where it is if that takes so many rows a member at most; deeper ones take many more.
VISITS = 16
#: Inside a node, a pair is looked at on full sets unless its signatures agree this many standard deviations
#: less than they would at the threshold (a pair there is passed over once in some 300,000 times a node).
SLACK = 5.0
CACHED_WORDS = 300_000
A, B, C, D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


class Shingler:
    """Texts to sorted arrays of distinct shingle hashes (64 bits)."""

    def __init__(self, width: int = SHINGLE):
        self.width = width
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        import xxhash
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        for w in set(words):
            if w not in self.known:
                self.known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        if not len(h):
            return h
        width = min(self.width, len(h))
        x = np.full(len(h) - width + 1, width, np.uint64)
        for i in range(width):
            x = (x ^ (x >> np.uint64(31))) * A + h[i:len(h) - width + 1 + i] * B
        x ^= x >> np.uint64(32)
        return np.unique(x * C)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of the set under each of ``PLACES`` random linear maps."""
    rng = np.random.default_rng(3)
    times = rng.integers(0, 2**31, PLACES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    plus = rng.integers(0, 2**32, PLACES, dtype=np.uint32)
    low = np.full(PLACES, 2**32 - 1, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 4096):
        np.minimum(low, (short[at:at + 4096, None] * times + plus).min(axis=0), out=low)
    return low


def profile(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``(doc_id, n_shingles, set_key, sig)``; the key and signature of an empty set are null."""

    def profiled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash
        shingler = Shingler(width)
        for batch in batches:
            sets = [shingler(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "n_shingles": [len(s) for s in sets],
                "set_key": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                "sig": [signature(s).tobytes() if len(s) else None for s in sets]})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(
        profiled, "doc_id long, n_shingles long, set_key binary, sig binary")


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * A
    x = (x ^ (x >> np.uint64(27))) * D
    return x ^ (x >> np.uint64(31))


def walk_on(sig: np.ndarray, nodes: np.ndarray, steps: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``sig`` and the nodes they reach, so many steps below one node each.

    A node branches on one place, or on two so often that 100 / percent is the mean: a pair at
    the threshold then shares one node on average at any depth.
    """
    rows = np.arange(len(sig))
    twice = np.uint64(int((100 / percent - 1) * 2**20))
    for _ in range(steps):
        choice = mix(nodes + A)
        parts = []
        for turn in range(2):
            go = slice(None) if not turn else (choice >> np.uint64(40)) % np.uint64(2**20) < twice
            place = ((choice[go] >> np.uint64(8 * turn)) % np.uint64(PLACES)).astype(np.int64)
            token = sig[rows[go], place].astype(np.uint64)
            parts.append((rows[go], mix(nodes[go] * C + np.uint64(turn) * D + token * B + place.astype(np.uint64))))
        rows, nodes = (np.concatenate(x) for x in zip(*parts))
    return rows, nodes


def walk(sig: np.ndarray, tree: int, depth: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``sig`` and the nodes they reach at ``depth`` of a tree."""
    return walk_on(sig, np.full(len(sig), mix(np.array([tree + 1], np.uint64))[0]), depth, percent)


def missed(percent: int, depth: int, trees: int) -> float:
    """Probability that a pair at the threshold shares no node at ``depth`` of so many trees.

    Given the share of places on which its signatures agree, trees are independent and a tree is a branching process.
    """
    at, twice, total = percent / 100, 100 / percent - 1, 0.0
    for agree in range(PLACES + 1):
        share, none = agree / PLACES, 0.0
        for _ in range(depth):
            lost = 1 - share * (1 - none)
            none = (1 - twice) * lost + twice * lost * lost
        total += math.comb(PLACES, agree) * at**agree * (1 - at)**(PLACES - agree) * none**trees
    return total


def trees_for(percent: int, depths: tuple[int, ...], recall: float) -> list[int]:
    """Trees per depth (never fewer at a larger one), each missing at most its part of ``1 - recall``."""
    counts, trees = [], LEAST
    for depth in depths:
        while missed(percent, depth, trees) > (1 - recall) / len(depths):
            trees += 1
        counts.append(trees)
    return counts


def nodes_of(reps: DataFrame, trees: range, depth: int, percent: int, above: int | None = None) -> DataFrame:
    """``(node, rep, label)`` at a depth, and ``parent``: the node at depth ``above``.

    ``reps`` has rep, sig and label.
    """

    def walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            sig = np.frombuffer(b"".join(batch["sig"]), np.uint32).reshape(len(batch), PLACES)
            rep, label = batch["rep"].to_numpy(np.int64), batch["label"].to_numpy(np.int64)
            for tree in trees:
                if above is None:
                    at, node = walk(sig, tree, depth, percent)
                    parent = np.zeros(len(at), np.uint64)
                else:
                    first, parent = walk(sig, tree, above, percent)
                    own = sig[first]
                    at, node = walk_on(own, parent, depth - above, percent)
                    at, parent = first[at], parent[at]
                yield pd.DataFrame({"node": node.view(np.int64), "parent": parent.view(np.int64),
                                    "rep": rep[at], "label": label[at]}).drop_duplicates(["node", "rep"])

    return reps.select("rep", "sig", "label").mapInPandas(
        walked, "node long, parent long, rep long, label long")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on full sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    same = int((both[1:] == both[:-1]).sum())
    return 100 * same >= percent * (len(a) + len(b) - same)


def linked(labels: list[int], sketch: np.ndarray, shingles: Callable[[int], np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between labels that tie together what similar documents connect; no pair inside one label.

    ``shingles(i)`` is the full set of the i-th document, asked for only when its signature comes near another's.
    """
    root = {k: k for k in labels}
    if len(root) < 2:
        return []

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    links, label = [], np.array(labels, np.int64)
    share = percent / 100
    least = PLACES * (share - SLACK * (share * (1 - share) / PLACES) ** 0.5)
    for i in range(len(labels) - 1):
        others = i + 1 + np.flatnonzero(label[i + 1:] != label[i])
        for j in others[(sketch[others] == sketch[i]).sum(axis=1) >= least].tolist():
            a, b = find(labels[i]), find(labels[j])
            if a != b and similar(shingles(i), shingles(j), percent):
                root[max(a, b)] = min(a, b)
                links.append((min(a, b), max(a, b)))
    return links


def compare(leaves: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """``(src, dst)`` links of labels among rows ``(leaf, rep, label)``; texts are ``(doc_id, sig, text)``.

    Rows are dealt by leaf and sorted by it, so a task holds one leaf at a time.
    """

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(width)

        def within(labels: list[int], sigs: list[bytes], own: list[str]) -> list[tuple[int, int]]:
            sketch = np.frombuffer(b"".join(sigs), np.uint32).reshape(len(labels), PLACES)
            return linked(labels, sketch, functools.cache(lambda i: shingler(own[i])), percent)

        open_leaf, labels, sigs, own, found = None, [], [], [], []
        for batch in batches:
            for leaf, label, sig, text in zip(batch["leaf"], batch["label"], batch["sig"], batch["text"]):
                if leaf != open_leaf:
                    found += within(labels, sigs, own)
                    open_leaf, labels, sigs, own = leaf, [], [], []
                labels.append(label)
                sigs.append(sig)
                own.append(text)
            if found:
                yield pd.DataFrame(found, columns=["src", "dst"])
                found = []
        yield pd.DataFrame(found + within(labels, sigs, own), columns=["src", "dst"], dtype="int64")

    rows = leaves.join(texts, leaves["rep"] == texts["doc_id"]).select("leaf", "label", "sig", "text")
    return rows.repartition("leaf").sortWithinPartitions("leaf").mapInPandas(
        compared, "src long, dst long").distinct()


def relabel(reps: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """Labels become the least label they are connected with."""
    if links.isEmpty():
        return reps
    groups = components(links).select(F.col("vertex").alias("label"), "component")
    return materialize(reps.join(groups, "label", "left").select(
        "rep", "sig", F.coalesce("component", "label").alias("label")), label)


def mixed_nodes(rows: DataFrame) -> DataFrame:
    """``(node, members, main, others)`` of nodes of more than one label: the most frequent one, and how many have another."""
    return (rows.groupBy("node", "label").agg(F.count(F.lit(1)).alias("_n"))
            .groupBy("node").agg(F.sum("_n").alias("members"), F.max_by("label", "_n").alias("main"), F.max("_n").alias("_most"))
            .withColumn("others", F.col("members") - F.col("_most")).where("others > 0").drop("_most"))


def dealt(rows: DataFrame, salt: int) -> DataFrame:
    """``(leaf, rep, label)``: nodes dealt at random into parts of about ``SMALL``, a row per row."""
    part = F.pmod(F.xxhash64("rep", F.lit(salt)), F.ceil(F.col("members") / SMALL))
    return rows.select(F.xxhash64("node", part).alias("leaf"), "rep", "label")


def whole(rows: DataFrame) -> DataFrame:
    """``(leaf, rep, label)`` so that any two documents of a node with different labels meet in a leaf.

    In a node above ``SMALL``, those of the main label need not meet each other.  They are dealt into parts, and
    each group of ``SMALL`` others visits every part: at most two rows a document when there is one group.
    """
    one = rows.where(F.col("members") <= SMALL).select(F.xxhash64("node").alias("leaf"), "rep", "label")
    large = rows.where(F.col("members") > SMALL).withColumns({
        "_parts": F.ceil((F.col("members") - F.col("others")) / SMALL), "_groups": F.ceil(F.col("others") / SMALL),
        "_main": F.col("label") == F.col("main")}).withColumn(
        "_own", F.pmod(F.xxhash64("rep", F.lit(0)), F.when(F.col("_main"), F.col("_parts")).otherwise(F.col("_groups"))))
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1)).alias("_at")
    main = large.where("_main").select("*", every("_groups")).select(
        F.xxhash64("node", "_own", "_at").alias("leaf"), "rep", "label")
    others = large.where("NOT _main").select("*", every("_parts")).select(
        F.xxhash64("node", "_at", "_own").alias("leaf"), "rep", "label")
    among = large.where("NOT _main AND _groups > 1").select("*", every("_groups")).where("_own <> _at").select(
        F.xxhash64("node", F.lit("others"), F.least("_own", "_at"), F.greatest("_own", "_at")).alias("leaf"), "rep", "label")
    return one.unionByName(main).unionByName(others).unionByName(among)


def visits() -> Column:
    """Rows that :func:`whole` makes of a node above ``SMALL``."""
    main, others = F.col("members") - F.col("others"), F.col("others")
    parts, groups = F.ceil(main / SMALL), F.ceil(others / SMALL)
    return main * groups + others * (parts + groups - 1)


def join(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE,
         recall: float = RECALL, depths: tuple[int, ...] = DEPTHS) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs(doc_id, text)``.

    Null and empty texts have an empty set and are linked with nothing.  Rows that share an id are one
    document.  Rows without an id are linked with nothing and have null component and kept.
    """
    profiles = materialize(profile(docs, width), "profiles")
    named = profiles.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    classes = materialize(named.groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.max("sig").alias("sig")), "classes")
    reps = classes.select("rep", "sig", F.col("rep").alias("label"))
    counts = trees_for(percent, depths, recall)
    met = nodes_of(reps, range(DEALING + counts[0]), depths[0], percent)
    company = met.join(mixed_nodes(met).select("node"), "node", "left_semi").select("rep").distinct()
    reps = materialize(reps.join(company, "rep", "left_semi"), "reps")
    texts = materialize(docs.select(F.col("doc_id").cast("long"), "text").join(
        reps.select(F.col("rep").alias("doc_id"), "sig"), "doc_id"), "texts")
    check = lambda leaves, label: materialize(compare(leaves, texts, percent, width), label)
    first = materialize(nodes_of(reps, range(DEALING), depths[0], percent), "nodes-first")
    reps = relabel(reps, check(dealt(first.join(mixed_nodes(first), "node"), 0), "links-first"), "reps-first")
    reps = _branch(reps, counts, depths, percent, check)
    groups = classes.join(reps.select("rep", "label"), "rep", "left").select(
        "set_key", F.coalesce("label", "rep").alias("component"))
    return (profiles.join(groups, "set_key", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
            .select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")))


def _branch(reps: DataFrame, counts: list[int], depths: tuple[int, ...], percent: int,
            check: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``reps`` with the labels that ``counts`` trees per depth tie together.

    What has many others beside its main label is dealt once more at random and labels are brought up to date.  A node
    is done when every two of its labels have met: in one leaf if it is small, part by part if that takes at most
    ``VISITS`` rows a member.  What remains walks on, along its own trees and those a larger depth has more.
    """
    rows = nodes_of(reps, range(DEALING, DEALING + counts[0]), depths[0], percent)
    for level, depth in enumerate(depths):
        rows = materialize(rows.select("node", "rep", "label"), f"nodes-{depth}")
        # labels only ever merge, so a node of one label stays so: its rows are done and get no new labels
        several = materialize(mixed_nodes(rows), f"several-{depth}")
        crowded = rows.join(several.where(F.col("others") > SMALL), "node")
        reps = relabel(reps, check(dealt(crowded, depth), f"dealt-{depth}"), f"reps-dealt-{depth}")
        rows = rows.join(several.select("node"), "node", "left_semi").select("node", "rep")
        rows = materialize(rows.join(reps.select("rep", "label"), "rep"), f"named-{depth}")
        active = materialize(mixed_nodes(rows), f"mixed-{depth}")
        last = level == len(depths) - 1
        few = F.lit(last) | (F.col("members") <= SMALL) | (visits() <= VISITS * F.col("members"))
        reps = relabel(reps, check(whole(rows.join(active.where(few), "node")), f"links-{depth}"), f"reps-{depth}")
        open_nodes = active.where(~few).select(F.col("node").alias("parent"))
        if last or open_nodes.isEmpty():
            return reps
        inside = rows.join(open_nodes, F.col("node") == F.col("parent"), "left_semi").select("rep").distinct()
        walkers = reps.join(inside, "rep", "left_semi")
        old, new = DEALING + counts[level], DEALING + counts[level + 1]
        rows = nodes_of(walkers, range(DEALING, old), depths[level + 1], percent, depth).join(open_nodes, "parent", "left_semi")
        if new > old:
            rows = rows.unionByName(nodes_of(walkers, range(old, new), depths[level + 1], percent))
    return reps


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(read(spark, sf_dir, "documents", "doc_id", "text"))
