"""From raw documents to packed training sequences, stage by stage.

Every stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet and read
again as the next one's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.llm import langid, mixing, packing, pathjoin, quality
from tastegraph.llm.common import read
from tastegraph.session import materialize, tune

#: A document goes when its main language has less than this share of it.
MAIN_LANGUAGE = 0.5
#: Whole texts that are handed to Python at a time.
BATCH = 1000


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of one main language; those without letters, without text or of no main language go."""
    _small_batches(spark)
    found = langid.guess(langid.learn(docs), F.col("text"))
    return docs.where((found["lang_pred"] != langid.UNKNOWN) & (found["score"] >= MAIN_LANGUAGE))


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of what has come this far, calls good.

    Rows without an id or a label are scored like all others; null and empty texts have a score too.
    """
    _small_batches(spark)
    score = quality.scorer(quality.learn(docs, read(spark, sf_dir, "labels", "doc_id", "quality")))
    return docs.where(score(F.col("text")) >= quality.THRESHOLD)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group of near copies, by five-word shingles and a similarity of 0.8.

    Rows are numbered as they stand, so rows that share an id and rows without one are told apart by
    their texts like all others; of equal rows one stays.  Null and empty texts are copies of nothing.
    """
    rows = materialize(docs.withColumn("_dedup_row", F.monotonically_increasing_id()), "dedup-rows")
    kept = pathjoin.join(rows.select(F.col("_dedup_row").alias("doc_id"), "text"), percent=80, width=5).where("kept")
    return rows.join(kept.select(F.col("doc_id").alias("_dedup_row")), "_dedup_row", "left_semi").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the target weights of the sources ask for, whatever its id; a null source is a source."""
    return mixing.emit(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 1,024 tokens; a null text is the end id alone."""
    return packing.pack(packing.cut(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", in_a_language), ("quality", of_quality), ("near duplicates", deduplicated),
    ("source mix", mixed), ("packing", packed)]

#: SQL has neither the classifiers, the similarity join nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = read(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{place}")
    return docs
