import random
import re

import pytest
from pyspark.sql import functions as F

from tastegraph.llm import pathjoin

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, width=3, percent=85):
    """Size and least linked id per document, from all pairs."""
    sets = {}
    for i, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        n = min(width, len(w))
        sets[i] = frozenset(tuple(w[j:j + n]) for j in range(len(w) - n + 1)) if w else frozenset()
    least = {i: i for i in sets}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            ra, rb = find(a), find(b)
            if ra != rb and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                least[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(i)) for i in sets}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_like_brute_force(spark, width, percent):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(40):  # families around the threshold, some with a passage shared by all
        base = rng.choices(words, k=rng.randint(3, 200))
        passage = words[:60] if rng.random() < 0.5 else []
        for _ in range(rng.randint(1, 6)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 20))):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own + passage))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(pathjoin.join(docs, percent, width)) == brute(rows, width, percent)


def test_large_groups_are_tied_together(spark, monkeypatch):
    """More near copies than a node may hold, beside a family that is close but not linked."""
    monkeypatch.setattr(pathjoin, "SMALL", 16)
    rng = random.Random(6)
    base = [f"b{i}" for i in range(120)]
    far = base[:88] + [f"f{i}" for i in range(32)]  # about 0.57 alike
    rows = []
    for i in range(300):
        own = list(base if i % 3 else far)
        own[rng.randrange(len(own))] = f"x{i}"
        rows.append((i, " ".join(own)))
    got = found(pathjoin.join(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(rows)
    assert len({c for _, c in got.values()}) == 2


def test_shingler_by_whole_texts():
    s = pathjoin.Shingler()
    assert len(s(None)) == len(s(" \n")) == 0
    assert len(s("a b")) == 1 and list(s("A b")) == list(s("a\tB")) and list(s("a b")) != list(s("b a"))
    assert list(s("É b c")) != list(s("é b c"))  # only A-Z is lowered
    assert len(s("a b c a b c d")) == 4


def test_odd_rows(odd, empty):
    rows = pathjoin.join(odd).collect()
    assert len(rows) == odd.count()
    got = {r["doc_id"]: r for r in rows}
    assert got[9]["component_id"] == got[2]["component_id"] == got[1]["component_id"] == 1
    assert all(got[i]["n_shingles"] == 0 and got[i]["kept"] for i in (3, 4, 5))
    assert got[6]["n_shingles"] == 1 and got[8]["n_shingles"] == 1
    assert got[None]["component_id"] is None and got[None]["kept"] is None
    assert pathjoin.join(empty).count() == 0


def test_single_links_inside_a_family(spark, monkeypatch):
    """Pairs at the threshold inside a family of unlinked documents larger than a node may hold: no other link helps."""
    monkeypatch.setattr(pathjoin, "SMALL", 8)
    rng = random.Random(7)
    words, texts, pairs = [f"w{i}" for i in range(130)], [], 400
    for _ in range(pairs):
        rng.shuffle(words)  # any word is in most documents: two of a family are about 0.63 alike, a pair 92 of 108
        texts += [words[:100], words[8:108]]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    got = found(pathjoin.join(spark.createDataFrame(rows, "doc_id long, text string"), width=1))
    want = brute(rows, 1)
    assert len({c for _, c in want.values()}) == pairs
    assert all(got[i][1] in (i, want[i][1]) for i in got)
    assert sum(got[i] != want[i] for i in got) <= 0.01 * pairs


def test_trees_follow_the_target():
    for percent in (80, 85):
        counts = pathjoin.trees_for(percent, pathjoin.DEPTHS, pathjoin.RECALL)
        assert sum(pathjoin.missed(percent, d, n) for d, n in zip(pathjoin.DEPTHS, counts)) <= 1 - pathjoin.RECALL
        assert counts[0] >= 8 and counts == sorted(counts)


def test_rows_follow_the_size_of_a_group(spark):
    """One node: a group of near copies beside some others, beside many others, and others only."""
    def emitted(main, others):
        rows = spark.range(main + others).select(F.lit(1).alias("node"), F.col("id").alias("rep"),
                                                 F.greatest(F.col("id") - main, F.lit(0)).alias("label"))
        rows = rows.join(pathjoin.mixed_nodes(rows), "node").cache()
        return rows, pathjoin.whole(rows)

    for main in (3_000, 30_000):
        assert emitted(main, 200)[1].count() <= 2 * (main + 200)
    for main, others in ((2_000, 700), (0, 600), (100, 100)):
        rows, leaves = emitted(main, others)
        where = {}
        for r in leaves.collect():
            where.setdefault(r["rep"], set()).add(r["leaf"])
        labels = {r["rep"]: r["label"] for r in rows.collect()}
        assert leaves.groupBy("leaf").count().agg(F.max("count")).first()[0] <= 2.6 * pathjoin.SMALL
        assert all(where[a] & where[b] for a in labels for b in range(main, main + others) if labels[a] != labels[b])


def test_only_nodes_of_several_labels_get_new_ones(spark, monkeypatch):
    rng, kept, store = random.Random(5), {}, pathjoin.materialize
    monkeypatch.setattr(pathjoin, "materialize", lambda df, label: kept.setdefault(label, store(df, label)))
    texts = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(500)) for _ in range(60)) for _ in range(40)]
    less = [" ".join(t.split()[:52] + ["other"] * 8) for t in texts[20:]]  # near, but below the threshold: such nodes stay mixed
    docs = [(i, t) for i, t in enumerate(texts + [f"{t} tail" for t in texts[:20]] + less)]
    got = found(pathjoin.join(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == brute(docs)
    rows = kept["named-3"].groupBy("node").count()
    assert rows.count() and rows.where("count < 2").isEmpty()
