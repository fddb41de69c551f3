import numpy as np

from tastegraph.llm import permindex

ROOT = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def exact(ids, vectors, query, top=5):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    s = unit @ unit[list(ids).index(query)]
    order = [i for i in np.lexsort((ids, -s.round(12))) if ids[i] != query][:top]
    return [(int(ids[i]), s[i]) for i in order]


def test_recall_and_scores(spark):
    rows = spark.read.parquet(f"{ROOT}/embeddings.parquet").collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got = {}
    for r in permindex.op10_nearest(spark, ROOT).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r)
    assert sorted(got) == [i for i in sorted(ids) if i % 50 == 0]
    hits = 0
    for q, found in got.items():
        want = dict(exact(ids, vectors, q))
        assert [r["rank"] for r in found] == [1, 2, 3, 4, 5]
        hits += sum(r["vec_id"] in want for r in found)
        assert all(abs(r["score"] - want[r["vec_id"]]) < 1e-12 for r in found if r["vec_id"] in want)
    assert hits / (5 * len(got)) >= 0.9


def test_several_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(permindex, "BLOCK", 7)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(400, 8))
    df = spark.createDataFrame([(i, [float(x) for x in v], None, None) for i, v in enumerate(vectors)], SCHEMA)
    out = permindex.neighbours(df, df.where("vec_id % 10 = 0"), shard=50, rerank=1.0).collect()
    vectors = vectors.astype(np.float32).astype(float)
    for q in range(0, 400, 10):
        found = sorted((r["rank"], r["vec_id"]) for r in out if r["query_id"] == q)
        assert [v for _, v in found] == [v for v, _ in exact(np.arange(400), vectors, q)]


def test_footrule():
    rng = np.random.default_rng(2)
    pivots, vectors = permindex.unit(rng.normal(size=(20, 6))), rng.normal(size=(50, 6))
    shard = permindex.Shard(np.arange(50), vectors, pivots, 5)
    own = permindex.places(permindex.unit(vectors), pivots, 5)
    q = own[3]
    at = lambda places, p: list(places).index(p) if p in places else 5
    want = [sum(abs(at(q, p) - at(o, p)) for p in range(20)) for o in own]
    assert list(shard.footrule(q)) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [None, 1.0]), (8, [-1.0, 0.0]), (None, [1.0, 0.0]), (50, [3.0, 0.0]), (100, None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    out = permindex.neighbours(df, df.where("vec_id % 50 = 0"))
    assert [tuple(r)[:3] for r in out.orderBy("query_id", "rank").collect()] == [
        (0, 1, 1), (0, 2, 50), (0, 3, 2), (0, 4, 8), (50, 1, 0), (50, 2, 1), (50, 3, 2), (50, 4, 8)]
    assert permindex.neighbours(df.limit(0), df.limit(0)).count() == 0
    assert permindex.neighbours(df, df.limit(0)).count() == 0


def a_third_copies(spark):
    """Ids and vectors of the embeddings, about a third of them made equal, and a table of them."""
    rows = spark.read.parquet(f"{ROOT}/embeddings.parquet").orderBy("vec_id").collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float32)
    same = np.random.default_rng(4).random(len(ids)) < 1 / 3
    vectors[same] = vectors[same][0]
    df = spark.createDataFrame([(int(i), v.tolist(), None, None) for i, v in zip(ids, vectors)], SCHEMA)
    return ids, vectors.astype(float), same, df


def recalls(ids, vectors, df):
    """Share of the exact five, by id, for each query."""
    got = {}
    for r in permindex.neighbours(df, df.where("vec_id % 25 = 0")).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    return {q: len(got[q] & {i for i, _ in exact(ids, vectors, q)}) / 5 for q in map(int, ids) if q % 25 == 0}


def test_many_copies_keep_their_least_ids(spark):
    """More copies than are ranked again: each query among them gets the least other ids."""
    ids, vectors, same, df = a_third_copies(spark)
    found = recalls(ids, vectors, df)
    inside = set(ids[same].tolist())
    assert {found[q] for q in found if q in inside} == {1.0}


def test_copies_are_one_pivot(spark):
    """Queries outside the copies keep their recall, for all pivots differ."""
    ids, vectors, same, df = a_third_copies(spark)
    rows = permindex.usable(df)
    pivots, _ = permindex.pivot_sample(permindex.distinct_vectors(rows, 6))
    assert len(pivots) == len(np.unique(pivots, axis=0)) == permindex.PIVOTS
    found = recalls(ids, vectors, df)
    inside = set(ids[same].tolist())
    assert np.mean([r for q, r in found.items() if q not in inside]) >= 0.9
    assert np.mean(list(found.values())) >= 0.9


def test_a_third_near_copies(spark):
    """More near copies than are ranked again, no two equal: recall inside and outside of them, and pivots that stand apart."""
    rng = np.random.default_rng(6)
    n = 6000
    vectors = rng.normal(size=(n, 64))
    same = rng.random(n) < 1 / 3
    vectors[same] = vectors[same][0] + rng.normal(size=(int(same.sum()), 64)) * 0.1
    vectors = vectors.astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist(), None, None) for i, v in enumerate(vectors)], SCHEMA)
    pivots, local = permindex.pivot_sample(permindex.distinct_vectors(permindex.usable(df), 6))
    near = pivots @ pivots.T
    assert len(pivots) == permindex.PIVOTS and near[~np.eye(len(pivots), dtype=bool)].max() <= permindex.APART and len(local) == 1
    found = recalls(np.arange(n), vectors, df)
    assert np.mean([r for q, r in found.items() if same[q]]) >= 0.9
    assert np.mean([r for q, r in found.items() if not same[q]]) >= 0.9
