from collections import defaultdict

from pyspark.sql import functions as F

from tastegraph.llm import mixing


def test_targets_share_what_is_over(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1), ("c", 1), (None, 98), ("a", 0)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    # weights 1, 2, 3, 1: b and c stop at 3, the other two share 194 evenly
    assert got == {"a": 97.0, "b": 3.0, "c": 3.0, None: 97.0}


def test_words_come_near_the_target_and_reruns_agree(spark):
    docs = spark.createDataFrame([(i, "abc"[i % 7 % 3], "w " * (1 + i * i % 37)) for i in range(3000)],
                                 "doc_id long, source string, text string")
    rows = mixing.mix(docs).collect()
    assert sorted(rows) == sorted(mixing.mix(docs.repartition(7)).collect())
    taken, target = defaultdict(int), {}
    for r in rows:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 37 for s in target)


def test_odd_rows(odd, empty):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    assert sum(r["size"] for r in rows if r["doc_id"] in (3, 4, 5)) == 0
    out = mixing.emit(odd)
    assert out.columns == odd.columns
    taken = mixing.mix_sizes(odd.select(F.monotonically_increasing_id().alias("doc_id"), "source", mixing.word_count(F.col("text")).alias("size")))
    assert out.count() == taken.agg(F.sum("copies")).first()[0]
    many = odd.where("source = 'a'").unionByName(odd.where("doc_id is null"))
    assert mixing.emit(many, [1]).where("doc_id is null").count() == 2  # one source takes its own size: every row once
    assert mixing.mix(empty).count() == mixing.emit(empty).count() == 0
