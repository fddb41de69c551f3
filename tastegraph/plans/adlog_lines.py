"""Advertising log lines derived from order lines.

``SPECIAL`` gives the text of the columns the jobs look at, in SQL that both
engines read; every other column is a constant of its type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.adlogs import AD_LOG_FIELDS
from ..sources.tables import table

TEXT = "CAST({} AS STRING)"


def _id(kind: int, form: str) -> str:
    """Identity text, empty by different divisors so that every precedence occurs."""
    seed = f"CONCAT('{form}{kind}-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING))"
    value = {"md5": f"md5({seed})", "sha1": f"sha1({seed})", "raw": seed}[form]
    divisor = {"md5": 2, "sha1": 3, "raw": 4}[form] + kind
    return f"CASE WHEN (l_partkey + {kind} * l_orderkey) % {divisor} = 0 THEN {value} ELSE '' END"


SPECIAL = {
    "sessionid": "CONCAT(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING))",
    "adorderid": TEXT.format("l_orderkey % 5"),
    "requestmode": TEXT.format("l_linenumber % 3 + 1"),
    "processnode": TEXT.format("l_suppkey % 4"),
    "iseffective": TEXT.format("CASE WHEN l_partkey % 7 < 5 THEN 1 ELSE 0 END"),
    "isbilling": TEXT.format("CASE WHEN l_partkey % 5 < 4 THEN 1 ELSE 0 END"),
    "isbid": TEXT.format("l_partkey % 2"),
    "iswin": TEXT.format("CASE WHEN l_partkey % 3 < 2 THEN 1 ELSE 0 END"),
    "winprice": TEXT.format("l_extendedprice"),
    "adpayment": TEXT.format("l_quantity * 10"),
    "pw": "CASE WHEN l_linenumber = 1 THEN 'wide' ELSE CAST(l_suppkey AS STRING) END",
    "bidfloor": "CASE WHEN l_linenumber = 2 THEN '' ELSE CAST(l_tax AS STRING) END",
    "appid": TEXT.format("l_suppkey"),
    "lat": "CASE WHEN l_partkey % 13 = 0 THEN 'n/a' ELSE CONCAT(CASE WHEN l_partkey % 2 = 0 THEN '-' ELSE '' END, CAST(l_partkey % 90 AS STRING), '.', CAST(100 + l_suppkey % 900 AS STRING)) END",
    "long": "CONCAT(CASE WHEN l_suppkey % 2 = 0 THEN '-' ELSE '' END, CAST(l_suppkey % 180 AS STRING), '.', CAST(100 + l_partkey % 900 AS STRING))",
    **{f"{k}{suffix}": _id(n, form) for form, suffix in (("md5", "md5"), ("sha1", "sha1"), ("raw", ""))
       for n, k in enumerate(("imei", "mac", "idfa", "openudid", "androidid"))},
}
CONSTANTS = {"string": "'x'", "int": "'7'", "double": "'0.5'"}
TEXTS = {name: SPECIAL.get(name, CONSTANTS[kind]) for name, kind in AD_LOG_FIELDS}


def ad_log_lines(spark: SparkSession, root: str, sep: str = ",") -> DataFrame:
    lines = table(spark, root, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                  "l_quantity", "l_extendedprice", "l_tax")
    return lines.select(F.concat_ws(sep, *[F.expr(TEXTS[n]) for n, _ in AD_LOG_FIELDS]).alias("value"))


# the answer kind of a coordinate follows the first hex digit of its MD5
COORD_DIGIT = "substr(md5(CONCAT(lat, ',', long)), 1, 1)"
ANSWER = f"""CASE
WHEN {COORD_DIGIT} < '4' THEN CONCAT('{{"status":0,"result":{{"business":"Area ', {COORD_DIGIT}, '","pois":[]}}}}')
WHEN {COORD_DIGIT} < '8' THEN CONCAT('{{"status":0,"result":{{"business":"","pois":[{{"tag":"cafe"}},{{"tag":""}},{{"tag":"shop ', {COORD_DIGIT}, '"}}]}}}}')
WHEN {COORD_DIGIT} < 'a' THEN '{{"status":0,"result":{{"business":" ","pois":[]}}}}'
WHEN {COORD_DIGIT} < 'd' THEN '{{"status":2,"result":{{"business":"Nowhere","pois":[]}}}}'
ELSE ' ' END"""
