"""Behaviour stream: parse, fold into the history, retrain, serve."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import literal_pattern
from ..operators import als

HISTORY_SCHEMA = "userid bigint, itemid bigint, rate double, ts bigint, batch_id bigint"
AUDIT_SCHEMA = "batch_rows bigint, history_rows bigint, total_rows bigint, batch_id bigint"
PERIOD = "6 seconds"


def behaviour_stream(spark: SparkSession, fmt: str, options: dict[str, str],
                     schema: str | None = None) -> DataFrame:
    """Message lines as a ``value`` column: ``kafka`` (needs its connector) or a file format."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema:
        reader = reader.schema(schema)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def parse_behaviour(lines: DataFrame, sep: str = ",") -> DataFrame:
    """``user,item,score,ts`` lines; those that do not parse are dropped."""
    p = F.split("value", literal_pattern(sep), -1)
    field = lambda i, t: F.get(p, F.lit(i)).try_cast(t)
    rows = lines.select(field(0, "bigint").alias("userid"), field(1, "bigint").alias("itemid"),
                        field(2, "double").alias("rate"), field(3, "bigint").alias("ts"))
    return rows.dropna()


def append_batch(batch: DataFrame, batch_id: int, history_path: str) -> int:
    """Store a batch under its own id, so that a replayed batch replaces itself; the rows stored.

    They are counted from the files: the source is read once.
    """
    path = f"{history_path}/batch_id={batch_id}"
    batch.write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path).count()


def audited(spark: SparkSession, audit_path: str, before: int) -> int:
    """Rows stored by all batches before this one, from the latest audit row."""
    try:
        rows = spark.read.schema(AUDIT_SCHEMA).parquet(audit_path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    last = rows.where(F.col("batch_id") < before).agg(F.max_by("total_rows", "batch_id")).first()[0]
    return last or 0


def read_history(spark: SparkSession, history_path: str, upto: int | None = None) -> DataFrame:
    df = spark.read.schema(HISTORY_SCHEMA).parquet(history_path)
    return df.where(F.col("batch_id") <= upto) if upto is not None else df


def _start(stream: DataFrame, handler, checkpoint: str, trigger: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=trigger) if trigger
            else writer.trigger(availableNow=True)).start()


def store(stream: DataFrame, history_path: str, audit_path: str, checkpoint: str,
          trigger: str | None = PERIOD) -> StreamingQuery:
    """Append each non-empty batch and note batch, history and total sizes."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = append_batch(batch, batch_id, history_path)
        if not rows:
            return
        history = audited(spark, audit_path, batch_id)
        sizes = spark.createDataFrame([(rows, history, history + rows)],
                                      "batch_rows bigint, history_rows bigint, total_rows bigint")
        sizes.coalesce(1).write.mode("overwrite").parquet(f"{audit_path}/batch_id={batch_id}")

    return _start(stream, handle, checkpoint, trigger)


def retrain(stream: DataFrame, history_path: str, model_path: str, output_path: str,
            checkpoint: str, users: DataFrame, k: int = 10, rank: int = 10, iters: int = 6,
            reg: float = 0.01, trigger: str | None = PERIOD) -> StreamingQuery:
    """Retrain on history plus batch whenever a batch has rows, then serve ``users``.

    The fit reads the stored history, so a replayed batch trains on the same
    rows.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        if not append_batch(batch, batch_id, history_path):
            return
        spark = batch.sparkSession
        training = read_history(spark, history_path, batch_id)
        als.save_model(als.train(training, rank, iters, reg), model_path)
        recs = als.recommend_for_users(als.load_model(model_path), users, k)
        recs.write.mode("overwrite").parquet(f"{output_path}/batch_id={batch_id}")

    return _start(stream, handle, checkpoint, trigger)
