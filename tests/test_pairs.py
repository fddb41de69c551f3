"""Pair statistics cover every pair, however the work is dealt."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tastegraph.operators import neighbours as N
from tastegraph.plans import load


def brute(rows, entity):
    """Sums of every pair a < b; rows that come twice count twice."""
    n, by_key = {}, {}
    for r in rows:
        e, h = r[entity], r[1 - entity]
        if e is not None:
            n[e] = n.get(e, 0) + 1
            if h is not None:
                by_key.setdefault(h, []).append((e, r[2]))
    out = {}
    for own in by_key.values():
        for a, x in own:
            for b, y in own:
                if a < b:
                    s = out.setdefault((a, b), [0, 0.0, 0.0, 0.0, 0.0, 0.0])
                    for i, v in enumerate((1, x * y, x, y, x * x, y * y)):
                        s[i] += v
    return {p: (*s, n[p[0]], n[p[1]]) for p, s in out.items()}


@pytest.mark.parametrize("entity", ["userid", "itemid"])
@pytest.mark.parametrize("posting,many", [(1000, 20000), (7, 20000), (7, 3)])
def test_every_pair_of_hot_and_cold_keys(spark, monkeypatch, entity, posting, many):
    monkeypatch.setattr(N, "MANY", many)
    rnd = random.Random(4)
    rows = [(u, i, 1 + 0.5 * rnd.randint(0, 8)) for u in range(40) for i in {0, *rnd.sample(range(90), rnd.randint(0, 12))}]
    rows += rows[:5] + [(None, 3, 2.0), (4, None, 1.5)]
    stored = spark.createDataFrame(rows, "userid long, itemid long, rate double")
    found = N.every_pair(stored, entity, "itemid" if entity == "userid" else "userid", posting)
    got = [tuple(r[c] for c in ("a", "b", *N.SUMS, "na", "nb")) for r in found.collect()]
    want = brute(rows, 0 if entity == "userid" else 1)
    assert len(got) == len(want) and {g[:2]: g[2:] for g in got} == want


def star(spark, at, lines):
    """``lines`` of (user, item, quantity) as the two tables that ratings are made of."""
    spark.createDataFrame([(n, i, float(q), datetime.datetime(2020, 1, 1 + n % 20)) for n, (_, i, q) in enumerate(lines)],
                          "l_orderkey long, l_partkey long, l_quantity double, l_shipdate timestamp").write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(n, u) for n, (u, _, _) in enumerate(lines)], "o_orderkey long, o_custkey long").write.parquet(f"{at}/orders.parquet")
    return str(at)


@pytest.mark.parametrize("name,n", [("item_pair_stats", 60 * 59 // 2), ("sim_correlation", 60 * 59 // 2), ("user_pair_stats", 55 * 54 // 2)])
def test_pairs_beyond_the_neighbours(spark, tmp_path, name, n):
    """One user rates 60 items and one item has 55 users: an entity has more partners than a neighbour list."""
    if name == "user_pair_stats":
        lines = [(u, 1, 1 + u % 9) for u in range(55)]
    else:
        lines = [(1, i, 1 + i % 9) for i in range(60)] + [(2, i, 1 + i % 4) for i in range(20)]
    root = star(spark, tmp_path, lines)
    found = load().QUERIES[name](spark, root)
    assert found.count() == found.select("a", "b").distinct().count() == n


@pytest.mark.parametrize("entity", ["userid", "itemid"])
@pytest.mark.parametrize("posting", [1000, 10])
def test_rounds_leave_the_neighbours_as_they_are(spark, monkeypatch, entity, posting):
    rnd = random.Random(5)
    rows = [(u, i, 1 + 0.5 * rnd.randint(0, 8)) for u in range(60) for i in rnd.sample(range(70), rnd.randint(1, 15))]
    stored = spark.createDataFrame(rows, "userid long, itemid long, rate double")
    by = "itemid" if entity == "userid" else "userid"
    search = lambda: sorted(tuple(r) for r in N.neighbours(stored, entity, by, 5, posting=posting, block=7).collect())
    whole = search()
    monkeypatch.setattr(N, "ROUND", 700)
    rounds = []
    real = N.materialize_rounds
    monkeypatch.setattr(N, "materialize_rounds", lambda some, label: real((rounds.append(label) or x for x in some), label))
    assert search() == whole and len(rounds) > 3


def test_written_tables_leave_no_shuffle_files(spark):
    """A stored table's shuffle files go with the write; the setting is as it was for other queries."""
    import glob
    import time
    from tastegraph import session
    files = lambda: len(glob.glob(f"{local}/**/shuffle_*.data", recursive=True))
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]
    before, was = files(), spark.conf.get(session.CLEANUP, "false")
    session.materialize(spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count(), "few")
    until = time.time() + 20
    while files() > before and time.time() < until:
        time.sleep(0.2)
    assert files() <= before and spark.conf.get(session.CLEANUP, "false") == was


@pytest.mark.parametrize("most", [4_000_000, 40])
def test_recommendations_are_the_same_in_rounds(spark, monkeypatch, most):
    from tastegraph.operators import cf
    monkeypatch.setattr(cf, "MOST", most)
    rnd = random.Random(6)
    rows = [(u, i, 1 + 0.5 * rnd.randint(0, 8)) for u in range(40) for i in rnd.sample(range(50), rnd.randint(1, 12))]
    stored = spark.createDataFrame([*rows, (None, 3, 2.0), (4, None, 1.5)], "userid long, itemid long, rate double")
    listed = lambda search: sorted(((r["userid"] is None, r["userid"], r["itemid"], r["score"]) for r in search(stored, k=7).collect()), key=str)
    whole = [listed(search) for search in (cf.item_cf, cf.user_cf)]
    monkeypatch.setattr(cf, "ROUND", 900)
    turns = []
    real = cf.materialize_rounds
    monkeypatch.setattr(cf, "materialize_rounds", lambda some, label: real((turns.append(label) or x for x in some), label))
    assert [listed(search) for search in (cf.item_cf, cf.user_cf)] == whole and len(turns) > 4


def test_compressed_text_is_cut_into_files(spark, tmp_path, monkeypatch):
    from tastegraph.sources import sinks
    monkeypatch.setattr(sinks, "FILE_LINES", 40)
    df = spark.range(0, 500, 1, 2).select("id", F.md5(F.lit("x")).alias("t"))
    for codec in ("none", "gzip"):
        sinks.write_text(df, str(tmp_path / codec), codec=codec)
    size = lambda codec: sum(f.stat().st_size for f in (tmp_path / codec).glob("part-*"))
    lines = lambda codec: sorted(r[0] for r in spark.read.text(str(tmp_path / codec)).collect())
    assert lines("gzip") == lines("none") and len(lines("none")) == 500 and size("gzip") * 3 < size("none")
    assert len(list((tmp_path / "gzip").glob("part-*.gz"))) == 14 and len(list((tmp_path / "none").glob("part-*"))) == 2


def test_the_ad_log_text_is_compressed(spark, monkeypatch):
    from pathlib import Path
    from tastegraph.plans import adlogs
    paths = []
    real = adlogs.scratch_path
    monkeypatch.setattr(adlogs, "scratch_path", lambda *a: paths.append(real(*a)) or paths[-1])
    assert load().QUERIES["ad_log_parse"](spark, "/root/testdata/sf0.001").count() > 0
    written = list(Path(paths[0]).glob("part-*"))
    assert written and all(f.name.endswith(".gz") for f in written)


@pytest.mark.parametrize("k", [3, 70])
def test_full_product_equals_brute_force(spark, monkeypatch, k):
    """Over several parts, strips and a width of scores that is looked through in pieces; equal scores go to smaller ids."""
    import numpy as np
    from tastegraph.operators import factors
    monkeypatch.setattr(factors, "ALL_USERS", 30)
    monkeypatch.setattr(factors, "ALL_ITEMS", 3000)
    monkeypatch.setattr(factors, "STRIP", 7)
    rng = np.random.default_rng(3)
    u, i = rng.integers(-3, 4, (50, 4)).astype(np.float32), rng.integers(-3, 4, (9000, 4)).astype(np.float32)
    table = lambda f: spark.createDataFrame([(n * 3, [float(x) for x in row]) for n, row in enumerate(f)], "id int, features array<float>")
    odd = spark.createDataFrame([(10**6, [float("nan")] * 4), (10**6 + 1, None)], "id int, features array<float>")
    got = factors.topk_of_all(table(u).unionByName(odd), table(i).unionByName(odd), k)
    order = np.argsort(-(u @ i.T), axis=1, kind="stable")[:, :k]
    want = {n * 3: [(float((u @ i.T)[n, c]), int(c) * 3) for c in order[n]] for n in range(50)}
    assert {r["id"]: [tuple(x) for x in r["best"]] for r in got.collect()} == want
    assert [tuple(r) for r in factors.topk_of_all(table(u), table(i).limit(0), k).collect()] == []
    # the search by bounds keeps the same items, with the rounding and ties of its own
    searched = factors.topk_from_factors(table(u), table(i), k, block_rows=512)
    assert {(r["user"], r["item"], r["score"]) for r in searched.collect()} == {(n, c, s) for n, b in want.items() for s, c in b}


def test_large_fits_run_alone_in_more_blocks(spark, monkeypatch):
    from tastegraph.operators import als
    monkeypatch.setattr(als, "FIT_RATINGS", 50)
    monkeypatch.setattr(als, "BLOCK_RATINGS", 20)
    used, pools, plain, pool = [], [], als.ALS, als.ThreadPoolExecutor
    monkeypatch.setattr(als, "ALS", lambda **s: used.append(s) or plain(**s))
    monkeypatch.setattr(als, "ThreadPoolExecutor", lambda n: pools.append(n) or pool(n))
    r = spark.createDataFrame([(u, i, float(1 + (u + i) % 5)) for u in range(20) for i in range(20)], "userid long, itemid long, rate double")
    als.grid_search(r, r.limit(30), (2,), (0.1, 1.0), (1,))
    assert pools == [1] and {(s["numUserBlocks"], s["numItemBlocks"], s["checkpointInterval"]) for s in used} == {(20, 20, 1)}
