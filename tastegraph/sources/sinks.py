"""Result sinks."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import materialize

FILE_LINES = 200_000  # of a compressed text file

def append_table(df: DataFrame, name: str) -> None:
    """Append to an existing table, columns matched by name."""
    view = f"append_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        columns = ", ".join(f"`{c}`" for c in df.columns)
        df.sparkSession.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {view}")
    finally:
        df.sparkSession.catalog.dropTempView(view)


def _files(df: DataFrame, files: int | None) -> DataFrame:
    return df.repartition(files) if files else df


def write_json(df: DataFrame, path: str, files: int | None = None) -> None:
    """Replace ``path``.  A fixed file count is opt-in: it limits the write to so many tasks."""
    _files(df, files).write.mode("overwrite").json(path)


def write_text(df: DataFrame, path: str, sep: str = ",", files: int | None = None, codec: str = "none") -> None:
    """One line per row; NULL is an empty field.  With several columns, a value that holds ``sep`` stops the job.

    Files of a ``codec`` are read whole, by one task each, so they hold ``FILE_LINES`` lines at most.
    """
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    if len(fields) > 1:
        fields = [F.when(~F.contains(f, F.lit(sep)), f).otherwise(
            F.raise_error(F.concat(F.lit("separator inside a value: "), f)).cast("string")) for f in fields]
    line = F.concat(*[part for f in fields for part in (F.lit(sep), f)][1:])
    writer = _files(df.select(line.alias("value")), files).write.mode("overwrite")
    (writer if codec == "none" else writer.option("maxRecordsPerFile", FILE_LINES)).option("compression", codec).text(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str],
               mode: str = "append", connections: int = 8) -> None:
    """Write over ``connections`` parallel connections; the rows are dealt anew, so what comes before keeps its tasks."""
    df.repartition(connections).write.jdbc(url, table, mode=mode, properties=properties)


def upsert_dict(new: DataFrame, old: DataFrame) -> DataFrame:
    """Merge ``(key, value, seq)`` rows: the highest ``seq`` of a key wins."""
    return old.unionByName(new).groupBy("key").agg(
        F.max_by("value", F.struct("seq", "value")).alias("value"), F.max("seq").alias("seq"))


def upsert_table(new: DataFrame, path: str, buckets: int = 64) -> DataFrame:
    """Upsert ``(key, value, seq)`` rows into the dictionary stored below ``path``; the merged table.

    The dictionary is partitioned by a hash of the key.  Only buckets in which a new row wins are read and
    written again, each as a whole, so files of other buckets stay as they are, the same rows once more
    change nothing, and a job that is run again after a failure ends with the same table.
    The number of buckets is kept with the data: every call for a path must name the same one.
    """
    spark = new.sparkSession
    schema = StructType([*new.select("key", "value", "seq").schema.fields, StructField("bucket", IntegerType())])
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")
    rows = new.select("key", "value", "seq")
    own = materialize(upsert_dict(rows, rows.limit(0)).withColumn("bucket", bucket), "upsert-new")
    stored = lambda: spark.read.schema(schema).option("basePath", path).parquet(path)
    try:
        old = stored()
        old.isEmpty()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        own.repartition("bucket").write.partitionBy("bucket").parquet(path)
        return stored()
    before = old.select("key", F.col("value").alias("_value"), F.col("seq").alias("_seq"), F.col("bucket").alias("_bucket"))
    wins = own.join(before, (own["key"].eqNullSafe(before["key"])) & (own["bucket"] == before["_bucket"]), "left").where(
        F.col("_seq").isNull() | (F.struct("seq", "value") > F.struct(F.col("_seq"), F.col("_value"))))
    touched = [r["bucket"] for r in wins.select("bucket").distinct().collect()]  # at most the number of buckets
    if touched:
        here = F.col("bucket").isin(touched)
        merged = upsert_dict(own.where(here).drop("bucket"), old.where(here).drop("bucket")).withColumn("bucket", bucket)
        materialize(merged, "upsert-merged").repartition("bucket").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    return stored()


def append_once(df: DataFrame, path: str, batch: str, column: str = "batch") -> None:
    """Append the rows of a named batch to the table stored below ``path``.

    A batch is a partition and replaces itself: a job that is run twice, or again after it failed half-way, appends once.
    """
    df.withColumn(column, F.lit(batch)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
