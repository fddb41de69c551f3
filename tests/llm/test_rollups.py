import re

import pytest
from tokenizers import Tokenizer

from tastegraph.llm import rollups
from tastegraph.session import scratch_path

CHANGES = "op string, source string, lang string, tokenizer string, tokens long, old_tokens long, extra string"


def changes(spark, *rows):
    return spark.createDataFrame([(*r, "x") for r in rows], CHANGES)


def totals(spark, path):
    return {tuple(r)[:3]: tuple(r)[3:] for r in rollups.totals(spark, path).collect()}


@pytest.fixture
def path(spark):
    path = scratch_path(spark, "rollup-test")
    rollups.create(spark, path)
    return path


def test_batches(spark, path):
    first = changes(spark, ("insert", "a", "en", "t1", 10, None), ("insert", "a", "en", "t1", 5, None),
                    ("insert", None, None, "t1", None, None), ("insert", "b", "fr", "t2", 7, None))
    assert rollups.commit(first, path, 1)
    assert not rollups.commit(first, path, 1)
    assert totals(spark, path) == {("a", "en", "t1"): (2, 15), (None, None, "t1"): (1, 0), ("b", "fr", "t2"): (1, 7)}
    rollups.commit(changes(spark, ("revise", "a", "en", "t1", 8, 5), ("delete", "b", "fr", "t2", 7, None)), path, 2)
    rollups.create(spark, path)  # keeps what is there
    assert totals(spark, path) == {("a", "en", "t1"): (2, 18), (None, None, "t1"): (1, 0)}
    rollups.commit(changes(spark), path, 3)
    to = scratch_path(spark, "rollup-compact")
    rollups.compact(spark, path, to)
    assert totals(spark, to) == totals(spark, path)
    assert not rollups.commit(first, to, 1)


def test_an_attempt_that_died_does_not_count(spark, path):
    spark.createDataFrame([(1, "dead", "a", "en", "t1", 9, 9)], rollups.DELTA).write.mode("append").parquet(
        f"{path}/deltas")
    assert totals(spark, path) == {}
    rollups.commit(changes(spark, ("insert", "a", "en", "t1", 10, None)), path, 1)
    assert totals(spark, path) == {("a", "en", "t1"): (1, 10)}


def test_racing_writers_count_once(spark, path):
    for attempt in ("m", "k"):
        spark.createDataFrame([(1, attempt, "a", "en", "t1", 1, 4)], rollups.DELTA).write.mode("append").parquet(
            f"{path}/deltas")
        spark.createDataFrame([(1, attempt)], rollups.COMMIT).write.mode("append").parquet(f"{path}/commits")
    assert totals(spark, path) == {("a", "en", "t1"): (1, 4)}


def test_unknown_change_stops(spark, path):
    with pytest.raises(Exception, match="unknown change: upsert"):
        rollups.commit(changes(spark, ("upsert", "a", "en", "t1", 1, None)), path, 1)


def history(rows):
    """The totals of the query's history, counted by the tokenizer itself."""
    import public_tokenizers
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    out = {}
    for r in rows:
        text = r["text"] or ""
        versions = {"words-1": len(re.findall(rollups.WORD, text))}
        if r["doc_id"] is None or r["doc_id"] % 7 != 3:
            versions["bpe-50k"] = len(own.encode(text, add_special_tokens=False).ids)
        for version, n in versions.items():
            docs, tokens = out.get((r["source"], r["lang"], version), (0, 0))
            out[r["source"], r["lang"], version] = docs + 1, tokens + n
    return out


def test_ids_like_the_tokenizer(spark):
    root = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{root}/documents.parquet").collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in rollups.op8_token_rollup(spark, root).collect()} == history(rows)


def test_odd_rows(odd, empty):
    """Null texts, sources, languages and ids, very long and repeated rows, clashing columns."""
    got = rollups.estimated_then_counted(odd)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()} == history(odd.collect())
    assert rollups.estimated_then_counted(empty).count() == 0
