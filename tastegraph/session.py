"""Session settings and the shared scratch folder.

Everything that has to outlive one job (materialised intermediate tables,
checkpoints, sink round trips) goes below the folder named by
``spark.checkpoint.dir``.  Where that is unset, a folder inside the session's warehouse takes its
place: the warehouse is shared as well.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "tastegraph", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         # split a hot join key even if the parent then needs one more exchange
         .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false"))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        b = b.config(key, value)
    return b.getOrCreate()


def tune(spark: SparkSession) -> None:
    """Runtime SQL settings every job of this package relies on."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # compute-heavy stages over small shuffles should still use every core
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
    # the JVM never compiles a method of more bytes; wide rows, such as log lines, then run in smaller ones
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def shared_dir(spark: SparkSession) -> str:
    """Root folder all executors can reach."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write once, read back: cuts the lineage and survives executor loss.

    Used where several branches read the same expensive intermediate, or where
    a loop would otherwise grow the plan.
    """
    return df.sparkSession.read.schema(df.schema).parquet(_written(df, label, partition_by))


def materialize_rounds(rounds: Iterable[DataFrame], label: str) -> DataFrame:
    """Write tables of one schema one after another and read them back as one.

    The shuffle files of a round are gone before the next one begins.
    """
    paths = []
    for df in rounds:
        paths.append(_written(df, label))
    return df.sparkSession.read.schema(df.schema).parquet(*paths)


def _written(df: DataFrame, label: str, partition_by: list[str] | None = None) -> str:
    path = scratch_path(df.sparkSession, label)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_dropped(df.sparkSession):
        writer.parquet(path)
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries run in here leave no shuffle files behind; those of a table that has been written serve nobody."""
    was = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, was)


def prepare_checkpoints(spark: SparkSession) -> None:
    """Give iterative estimators a reliable checkpoint folder when none is set."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
