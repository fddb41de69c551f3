"""Text sources and sinks, checked by reading back what was written."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.vectors import parts
from ..session import scratch_path
from ..sources import sinks, text_files
from ..sources.tables import load_items, load_ratings, table
from . import base_sql  # noqa: F401
from .registry import query


def _written(df, sep, label):
    path = scratch_path(df.sparkSession, label)
    sinks.write_text(df, path, sep)
    return path


@query("src_ratings_text", "SELECT userid, itemid, rate, ts FROM ratings")
def src_ratings_text(spark, root):
    return text_files.read_ratings_text(spark, _written(load_ratings(spark, root), "::", "ratings-text"))


@query("src_ratings_collapsed", "SELECT userid, itemid, rate, ts FROM ratings")
def src_ratings_collapsed(spark, root):
    # alternate short and long separator runs, and pad the line
    sep = F.when(F.pmod("itemid", F.lit(2)) == 0, ":").otherwise(":::")
    line = F.concat(F.lit("  "), F.col("userid").cast("string"), sep, F.col("itemid").cast("string"),
                    F.lit("::"), F.col("rate").cast("string"), sep, F.col("ts").cast("string"), F.lit(" "))
    path = _written(load_ratings(spark, root).select(line.alias("value")), ",", "ratings-collapsed")
    return text_files.read_ratings_collapsed(spark, path)


@query("src_behaviour_csv", """
SELECT user_id AS userid, CAST(json_extract_string(props, '$.k') AS BIGINT) AS itemid, value AS rate,
       CAST(floor(epoch(ts)) AS BIGINT) AS ts FROM events""")
def src_behaviour_csv(spark, root):
    from .streams import behaviour_rows
    return text_files.read_behaviour_csv(spark, _written(behaviour_rows(spark, root), ",", "behaviour"))


@query("src_catalogue", "SELECT itemid, title FROM items")
def src_catalogue(spark, root):
    items = load_items(spark, root).select("itemid", "title", "genre")
    return text_files.read_catalogue(spark, _written(items, "::", "catalogue"))


@query("src_personal_ratings", """
SELECT userid, itemid, CAST(rate - 1 AS DOUBLE) AS rate FROM ratings WHERE rate - 1 > 0""")
def src_personal_ratings(spark, root):
    r = load_ratings(spark, root).select("userid", "itemid", (F.col("rate") - 1).alias("rate"), "ts")
    return text_files.read_personal_ratings(spark, _written(r, "::", "personal"))


@query("src_labeled_points", """
SELECT CAST(label AS DOUBLE) AS label, len(embedding) AS n,
       array_to_string([CAST(round(CAST(v AS DOUBLE) * 1000000) AS BIGINT) FOR v IN embedding], ',') AS features
FROM embeddings""")
def src_labeled_points(spark, root):
    values = F.transform("embedding", lambda v: v.cast("double").cast("string"))
    line = F.concat(F.lit("("), F.col("label").cast("string"), F.lit(",["), F.array_join(values, ","), F.lit("])"))
    path = _written(table(spark, root, "embeddings", "label", "embedding").select(line.alias("value")), ",", "points")
    array = vector_to_array("features")
    return text_files.read_labeled_points(spark, path).select(
        "label", F.size(array).cast("bigint").alias("n"), F.array_join(F.transform(
            array, lambda v: F.round(v * 1000000).cast("bigint").cast("string")), ",").alias("features"))


@query("src_sparse_points", """
SELECT CAST(label AS DOUBLE) AS label, len(embedding) AS size, array_to_string([i - 1 FOR i IN places], ',') AS indices,
       array_to_string([CAST(round(CAST(embedding[i] AS DOUBLE) * 1000000) AS BIGINT) FOR i IN places], ',') AS features
FROM (SELECT *, [i FOR i IN range(1, len(embedding) + 1) IF abs(embedding[i]) >= 0.1] AS places FROM embeddings)""")
def src_sparse_points(spark, root):
    """Points of which only the entries of at least 0.1 are kept, through text lines and sparse vectors."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    at = F.filter(F.sequence(F.lit(0), F.size("embedding") - 1), lambda i: F.abs(F.get(F.col("embedding"), i)) >= F.lit(0.1).cast("float"))
    text = lambda xs: F.concat(F.lit("["), F.array_join(xs.cast("array<string>"), ","), F.lit("]"))
    line = F.concat(F.lit("("), F.col("label").cast("string"), F.lit(",("), F.size("embedding").cast("string"), F.lit(","), text(at),
                    F.lit(","), text(F.transform(at, lambda i: F.get(v, i))), F.lit("))"))
    path = _written(table(spark, root, "embeddings", "label", "embedding").select(line.alias("value")), ",", "sparse-points")
    got = text_files.read_sparse_points(spark, path).select("label", parts(F.col("features")).alias("v"))
    return got.select("label", F.col("v.size").cast("bigint").alias("size"), F.array_join(F.col("v.indices").cast("array<string>"), ",").alias("indices"),
                      F.array_join(F.transform("v.values", lambda x: F.round(x * 1000000).cast("bigint").cast("string")), ",").alias("features"))


@query("app_dict", """
SELECT CAST(s_suppkey AS VARCHAR) AS appid, s_name AS appname FROM supplier WHERE s_suppkey % 7 <> 0""")
def app_dict(spark, root):
    s = table(spark, root, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    tail = F.when(F.pmod("s_suppkey", F.lit(7)) == 0, "").otherwise(",a,b")
    line = F.concat(F.concat_ws(",", F.col("s_nationkey").cast("string"), F.col("s_suppkey").cast("string"), "s_name"), tail)
    return text_files.read_app_dict(spark, _written(s.select(line.alias("value")), ",", "app-dict"))


@query("dict_upsert", """
SELECT key, arg_max(value, seq) AS value, max(seq) AS seq FROM (
  SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS value, CAST(-1 AS BIGINT) AS seq FROM nation
  UNION ALL SELECT CAST(c_nationkey AS VARCHAR), c_name, c_custkey FROM customer
  UNION ALL SELECT c_mktsegment || CAST(c_custkey AS VARCHAR), c_name, c_custkey FROM customer) GROUP BY 1""")
def dict_upsert(spark, root):
    old = table(spark, root, "nation").select(
        F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("value"),
        F.lit(-1).cast("bigint").alias("seq"))
    c = table(spark, root, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    keys = F.array(F.col("c_nationkey").cast("string"), F.concat("c_mktsegment", F.col("c_custkey").cast("string")))
    new = c.select(F.explode(keys).alias("key"), F.col("c_name").alias("value"), F.col("c_custkey").alias("seq"))
    path = scratch_path(spark, "dict")
    sinks.upsert_table(old, path)
    return sinks.upsert_table(new, path).select("key", "value", "seq")


@query("sink_append_roundtrip", """
SELECT userid, itemid, rate FROM ratings UNION ALL SELECT userid, itemid, rate FROM ratings WHERE rate > 3""")
def sink_append_roundtrip(spark, root):
    name, path = f"ratings_{uuid.uuid4().hex}", scratch_path(spark, "append")
    spark.sql(f"CREATE TABLE {name} (userid BIGINT, itemid BIGINT, rate DOUBLE) USING parquet LOCATION '{path}'")
    r = load_ratings(spark, root).select("userid", "itemid", "rate")
    sinks.append_table(r, name)
    sinks.append_table(r.where(F.col("rate") > 3), name)
    spark.sql(f"DROP TABLE {name}")  # the rows stay at their path
    return spark.read.schema("userid bigint, itemid bigint, rate double").parquet(path)


@query("sink_append_once", """
SELECT userid, itemid, rate, 'all' AS batch FROM ratings UNION ALL SELECT userid, itemid, rate, 'good' FROM ratings WHERE rate > 3""")
def sink_append_once(spark, root):
    """Two named batches, the first of them run twice."""
    path, r = scratch_path(spark, "append-once"), load_ratings(spark, root).select("userid", "itemid", "rate")
    sinks.append_once(r, path, "all")
    sinks.append_once(r.where(F.col("rate") > 3), path, "good")
    sinks.append_once(r, path, "all")
    return spark.read.schema("userid bigint, itemid bigint, rate double, batch string").parquet(path)


@query("sink_json_roundtrip", "SELECT itemid, title, genre FROM items")
def sink_json_roundtrip(spark, root):
    path = scratch_path(spark, "json")
    sinks.write_json(load_items(spark, root), path)
    return spark.read.schema("itemid bigint, title string, genre string").json(path)


@query("sink_text_roundtrip", "SELECT userid || ',' || itemid || ',' || rate AS line FROM ratings")
def sink_text_roundtrip(spark, root):
    r = load_ratings(spark, root).select("userid", "itemid", "rate")
    return spark.read.text(_written(r, ",", "text")).select(F.col("value").alias("line"))
