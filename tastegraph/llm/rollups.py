"""Token counts kept as delta-maintained rollups.

A batch of changes is turned into signed rows (an insert adds a document, a delete takes
it away, a revision takes the old count away and adds the new one), summed per source,
language and tokenizer version, and appended.  Totals are the sum of all committed
deltas, so no earlier batch is read again to take in a new one.

Commit protocol: a delta file carries its batch and a fresh attempt name; then one row
``(batch_id, attempt)`` is appended to ``commits``.  Only that row makes the attempt
count, and the least attempt of a batch wins.  A batch that comes again is not
written; one that died between the two writes, or two writers racing, leave deltas
that no total reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from . import bpe
from .common import WORD, read

KEYS = ("source", "lang", "tokenizer")
DELTA = "batch_id long, attempt string, source string, lang string, tokenizer string, docs long, tokens long"
COMMIT = "batch_id long, attempt string"


def create(spark: SparkSession, path: str) -> None:
    """An empty rollup; one that is there already stays as it is."""
    for name, schema in (("deltas", DELTA), ("commits", COMMIT)):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/{name}")


def signed(changes: DataFrame) -> DataFrame:
    """``(source, lang, tokenizer, docs, tokens)``, one signed sum per key.

    ``changes``: op (insert, delete or revise), source, lang, tokenizer, tokens, and
    old_tokens for revisions.  Null keys are keys of their own, null counts are 0; any
    other op stops the job.
    """
    known = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).when(
        F.col("op") == "revise", 0)
    sign = F.coalesce(known, F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("op", F.lit("null")))
                                           ).cast("int"))
    tokens, old = (F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("tokens", "old_tokens"))
    moved = F.when(F.col("op") == "revise", tokens - old).otherwise(sign * tokens)
    return changes.groupBy(*KEYS).agg(F.sum(sign).cast("long").alias("docs"),
                                      F.sum(moved).cast("long").alias("tokens"))


def committed(spark: SparkSession, path: str) -> DataFrame:
    """The attempt that counts for each batch; one row per batch."""
    return spark.read.schema(COMMIT).parquet(f"{path}/commits").groupBy("batch_id").agg(
        F.min("attempt").alias("attempt"))


def commit(changes: DataFrame, path: str, batch_id: int) -> bool:
    """Take in one batch; False if it was taken in before.  Fits ``foreachBatch``."""
    spark = changes.sparkSession
    if not committed(spark, path).where(F.col("batch_id") == batch_id).isEmpty():
        return False
    attempt = uuid.uuid4().hex
    own = [F.lit(batch_id).cast("long").alias("batch_id"), F.lit(attempt).alias("attempt")]
    signed(changes).select(*own, *KEYS, "docs", "tokens").write.mode("append").parquet(f"{path}/deltas")
    spark.createDataFrame([(batch_id, attempt)], COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return True


def totals(spark: SparkSession, path: str) -> DataFrame:
    """``(source, lang, tokenizer, docs, tokens)`` over all committed batches; keys without documents go."""
    deltas = spark.read.schema(DELTA).parquet(f"{path}/deltas")
    return (deltas.join(committed(spark, path), ["batch_id", "attempt"]).groupBy(*KEYS)
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where(F.col("docs") != 0))


def compact(spark: SparkSession, path: str, to: str) -> None:
    """Write a rollup of one delta per batch and key, without deltas that never counted."""
    deltas = spark.read.schema(DELTA).parquet(f"{path}/deltas")
    deltas.join(committed(spark, path), ["batch_id", "attempt"]).groupBy("batch_id", "attempt", *KEYS).agg(
        F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.parquet(f"{to}/deltas")
    committed(spark, path).write.parquet(f"{to}/commits")


#: Two versions of a plain tokenizer: words, and runs of word characters or single marks.
VERSIONS = {"words-1": WORD, "words-2": r"[\p{L}\p{N}]+|[^\x20\x09-\x0D\p{L}\p{N}]"}
#: The version that counts the ids of a byte-level vocabulary.
IDS = "bpe-50k"


def count(text: Column, version: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(VERSIONS[version])), F.lit(0)).cast("long")


def counted(docs: DataFrame, path: str | None = None, pat: str | None = None) -> DataFrame:
    """``(doc_id, source, lang, words, ids)``: words and ids of each whole text; null and empty texts have none.

    A row per row of ``docs``, whatever its id; other columns are not read.
    """
    own = bpe.Encoder(bpe.load_ranks(path or bpe.rank_file()), pat or bpe.pattern())

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(4).to_pylist()]
            n = [len(ids) // 4 for lo, hi in bpe.blocks([len(t) for t in texts], bpe.BLOCK) for ids in own(texts[lo:hi])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(n, pa.int64())],
                                             ["doc_id", "source", "lang", "words", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "source", "lang", count(F.col("text"), "words-1").alias("words"),
                       "text").mapInArrow(counts, "doc_id long, source string, lang string, words long, ids long")


def changes(rows: DataFrame, op: str, tokenizer: str, tokens: str, old: str | None = None) -> DataFrame:
    """One change a row, for :func:`commit`: counts come from the columns ``tokens`` and ``old``."""
    return rows.select(F.lit(op).alias("op"), "source", "lang", F.lit(tokenizer).alias("tokenizer"),
                       F.col(tokens).alias("tokens"), (F.col(old) if old else F.lit(None).cast("long")).alias("old_tokens"))


def remainder_is(n: int, value: int) -> Column:
    """Whether the id leaves ``value``; never for rows without an id."""
    return F.coalesce(F.pmod("doc_id", F.lit(n)) == value, F.lit(False))


def estimated_then_counted(docs: DataFrame) -> DataFrame:
    """Totals after a history: every document comes in under the ids' version with its words as an estimate, a seventh
    (by id) is deleted, all others are revised to the ids counted, and every document is added under words-1.

    Two batches are sent twice.  The totals are those of the compacted rollup.
    """
    spark = docs.sparkSession
    docs = materialize(counted(docs), "rollup-counts")
    path, compacted = scratch_path(spark, "rollup"), scratch_path(spark, "rollup-compacted")
    create(spark, path)
    gone = remainder_is(7, 3)
    first, deletes = changes(docs, "insert", IDS, "words"), changes(docs.where(gone), "delete", IDS, "words")
    for batch_id, batch in [(0, first), (1, deletes), (1, deletes), (2, changes(docs.where(~gone), "revise", IDS, "ids", "words")),
                            (3, changes(docs, "insert", "words-1", "words")), (0, first)]:
        commit(batch, path, batch_id)
    compact(spark, path, compacted)
    return totals(spark, compacted)


def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return estimated_then_counted(read(spark, sf_dir, "documents", "doc_id", "source", "lang", "text"))


def token_rollup_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup over counts that SQL has too.  All documents come in by words-1; a seventh is deleted, a fifth of
    the rest revised to words-2 counts, and every document is added under words-2.  Two batches are sent twice."""
    docs = materialize(read(spark, sf_dir, "documents", "doc_id", "source", "lang", "text").select(
        "doc_id", "source", "lang", count(F.col("text"), "words-1").alias("one"),
        count(F.col("text"), "words-2").alias("two")), "rollup-counts")
    path = scratch_path(spark, "rollup")
    create(spark, path)
    gone, revised = remainder_is(7, 3), remainder_is(5, 1)
    deletes = changes(docs.where(gone), "delete", "words-1", "one")
    batches = [(0, changes(docs, "insert", "words-1", "one")), (1, deletes), (1, deletes),
               (2, changes(docs.where(~gone & revised), "revise", "words-1", "two", "one")),
               (3, changes(docs, "insert", "words-2", "two")), (0, changes(docs, "insert", "words-1", "one"))]
    for batch_id, batch in batches:
        commit(batch, path, batch_id)
    return totals(spark, path)


ORACLE = f"""WITH c AS (
  SELECT doc_id, source, lang, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS one,
         coalesce(len(regexp_extract_all(text, '{VERSIONS["words-2"]}')), 0) AS two FROM documents),
r AS (SELECT source, lang, 'words-1' AS tokenizer, CASE WHEN doc_id % 5 = 1 THEN two ELSE one END AS n
      FROM c WHERE doc_id % 7 <> 3 UNION ALL SELECT source, lang, 'words-2', two FROM c)
SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens FROM r GROUP BY ALL"""
