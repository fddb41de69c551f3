"""Behaviour stream queries, run to completion over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.sinks import write_text
from ..sources.tables import table
from ..streaming import retrain as R
from .registry import cte, query

cte("behaviour", """
SELECT user_id AS userid, CAST(json_extract_string(props, '$.k') AS BIGINT) AS itemid, value AS rate,
       CAST(floor(epoch(ts)) AS BIGINT) AS ts FROM events""")


def behaviour_rows(spark, root):
    """``(userid, itemid, rate, ts)`` of every event; ts in whole seconds."""
    micros = F.unix_micros(F.col("ts").cast("timestamp_ltz"))
    return table(spark, root, "events", "user_id", "props", "value", "ts").select(
        F.col("user_id").alias("userid"), F.get_json_object("props", "$.k").cast("bigint").alias("itemid"),
        F.col("value").alias("rate"), F.floor(micros / 1000000).cast("bigint").alias("ts"))


def _lines(spark, root):
    """The events as text files, offered to the stream in two batches."""
    path, slots = scratch_path(spark, "behaviour-lines"), spark.sparkContext.defaultParallelism
    write_text(behaviour_rows(spark, root), path, files=2 * slots)
    options = {"path": path, "maxFilesPerTrigger": str(slots)}
    return R.parse_behaviour(R.behaviour_stream(spark, "text", options, "value string"))


def _store(spark, root):
    base = scratch_path(spark, "stream")
    q = R.store(_lines(spark, root), f"{base}/history", f"{base}/audit", f"{base}/checkpoint", trigger=None)
    q.awaitTermination()
    return base


@query("stream_parse", "SELECT userid, itemid, rate, ts FROM behaviour")
def stream_parse(spark, root):
    return R.read_history(spark, f"{_store(spark, root)}/history").select("userid", "itemid", "rate", "ts")


@query("stream_batch_counts", """
SELECT CAST(b AS BIGINT) AS batch, true AS has_rows, true AS follows, true AS adds_up,
       CASE WHEN b = 1 THEN (SELECT count(*) FROM behaviour) END AS all_rows FROM range(2) t(b)""")
def stream_batch_counts(spark, root):
    """Every audit row: what came before it, and that the last one has counted all rows."""
    audit = spark.read.parquet(f"{_store(spark, root)}/audit").withColumn("batch", F.col("batch_id").cast("bigint"))
    before = audit.select((F.col("batch") + 1).alias("batch"), F.col("total_rows").alias("before"))
    return audit.join(before, "batch", "left").select(
        "batch", (F.col("batch_rows") > 0).alias("has_rows"),
        (F.col("history_rows") == F.coalesce("before", F.lit(0))).alias("follows"),
        (F.col("total_rows") == F.col("history_rows") + F.col("batch_rows")).alias("adds_up"),
        F.when(F.col("batch") == 1, F.col("total_rows")).alias("all_rows"))


@query("stream_retrain", """
SELECT userid, CAST(r AS BIGINT) AS rank, true AS finite
FROM (SELECT DISTINCT userid FROM behaviour WHERE userid < 30), range(1, 11) t(r)""")
def stream_retrain(spark, root):
    base = scratch_path(spark, "stream")
    users = spark.range(30).select(F.col("id").alias("userid"))
    q = R.retrain(_lines(spark, root), f"{base}/history", f"{base}/model", f"{base}/recs",
                  f"{base}/checkpoint", users, trigger=None)
    q.awaitTermination()
    recs = spark.read.parquet(f"{base}/recs")
    served = recs.join(recs.agg(F.max("batch_id").alias("batch_id")), "batch_id")
    return served.select("userid", "rank", (F.abs("score") < float("inf")).alias("finite"))
