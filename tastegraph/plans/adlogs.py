"""Advertising log, geohash and geocoder queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import adlog, geo
from ..functions.casts import to_double, to_int
from ..session import materialize, scratch_path
from ..sources import adlogs
from ..sources.adlogs import AD_LOG_FIELDS
from ..sources.sinks import write_text
from ..sources.tables import table
from .adlog_lines import ANSWER, TEXTS, ad_log_lines
from .registry import cte, query

_SQL_TYPED = {
    "string": "{}", "double": "coalesce(TRY_CAST({} AS DOUBLE), 0.0)",
    "int": "CAST(coalesce(trunc(TRY_CAST({} AS DOUBLE)), 0) AS INTEGER)"}
cte("ad_logs", "SELECT " + ",\n ".join(
    f'{_SQL_TYPED[k].format("(" + TEXTS[n] + ")")} AS "{n}"' for n, k in AD_LOG_FIELDS) + " FROM lineitem")


def _logs(spark, root):
    return adlogs.parse_ad_logs(ad_log_lines(spark, root))


@query("ad_log_parse", "SELECT * FROM ad_logs")
def ad_log_parse(spark, root):
    path = scratch_path(spark, "ad-log-text")
    write_text(ad_log_lines(spark, root), path, codec="gzip")
    return adlogs.read_ad_logs(spark, path)


# Identity columns by precedence.
IDS = [f"{k}{s}" for s in ("md5", "sha1", "") for k in ("imei", "mac", "idfa", "openudid", "androidid")]
ANY_ID = " OR ".join(f"{c} <> ''" for c in IDS)


@query("ad_has_id", f"SELECT sessionid, ({ANY_ID}) AS has_id FROM ad_logs")
def ad_has_id(spark, root):
    return _logs(spark, root).select("sessionid", adlog.has_id().alias("has_id"))


@query("ad_uuid", "SELECT sessionid, CASE " + " ".join(
    f"WHEN {c} <> '' THEN '{c}:' || {c}" for c in IDS) + " END AS uuid FROM ad_logs")
def ad_uuid(spark, root):
    return _logs(spark, root).select("sessionid", adlog.primary_id().alias("uuid"))


@query("ad_all_ids", "SELECT sessionid, concat_ws('|', " + ", ".join(
    f"CASE WHEN {c} <> '' THEN '{c}:' || {c} END" for c in IDS) + ") AS ids FROM ad_logs")
def ad_all_ids(spark, root):
    return _logs(spark, root).select("sessionid", F.array_join(adlog.all_ids(), "|").alias("ids"))


@query("ad_kpis", """
SELECT sessionid, CASE WHEN requestmode = 1 AND processnode >= 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS requests,
  CASE WHEN requestmode = 1 AND processnode >= 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS effective_requests,
  CASE WHEN requestmode = 1 AND processnode = 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS ad_requests,
  CASE WHEN k = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS bids, CASE WHEN k = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS wins,
  CASE WHEN k = 2 THEN adpayment / 1000 ELSE 0.0::DOUBLE END AS payment,
  CASE WHEN k = 2 THEN winprice / 1000 ELSE 0.0::DOUBLE END AS cost,
  CASE WHEN requestmode = 2 AND iseffective = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS shows,
  CASE WHEN requestmode = 3 AND iseffective = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS clicks
FROM (SELECT *, CASE WHEN iseffective = 1 AND isbilling = 1 AND isbid = 1 AND adorderid <> 0 THEN 1
                     WHEN iseffective = 1 AND isbilling = 1 AND iswin = 1 THEN 2 ELSE 0 END AS k FROM ad_logs)""")
def ad_kpis(spark, root):
    return _logs(spark, root).select("sessionid", *adlog.kpi_columns())


@query("safe_cast", """
SELECT event_id, coalesce(TRY_CAST(event_type AS DOUBLE), 0.0) AS bad, value AS good,
       CAST(trunc(value) AS INTEGER) AS whole, coalesce(TRY_CAST(props AS INTEGER), 0) AS bad_int FROM events""")
def safe_cast(spark, root):
    e = table(spark, root, "events", "event_id", "event_type", "value", "props")
    text = F.col("value").cast("string")
    return e.select("event_id", to_double(F.col("event_type")).alias("bad"), to_double(text).alias("good"),
                    to_int(text).alias("whole"), to_int(F.col("props")).alias("bad_int"))


cte("coords", "SELECT DISTINCT lat, long FROM ad_logs")
cte("coord_cells", """
SELECT lat, long,
 CAST(least(greatest(floor((coalesce(TRY_CAST(lat AS DOUBLE), 0.0) + 90) / 180 * 1073741824), 0), 1073741823) AS BIGINT) AS la,
 CAST(least(greatest(floor((coalesce(TRY_CAST(long AS DOUBLE), 0.0) + 180) / 360 * 1073741824), 0), 1073741823) AS BIGINT) AS lo
FROM coords""")
cte("coord_hash", """
SELECT lat, long, list_aggregate([substr('0123456789bcdefghjkmnpqrstuvwxyz', 1 + CAST(list_sum(
   [CASE WHEN (c * 5 + b) % 2 = 0 THEN ((lo >> (29 - (c * 5 + b) // 2)) & 1) ELSE ((la >> (29 - (c * 5 + b) // 2)) & 1) END
    * (1 << (4 - b)) FOR b IN range(0, 5)]) AS INTEGER), 1) FOR c IN range(0, 12)], 'string_agg', '') AS geohash
FROM coord_cells""")


@query("geohash", "SELECT lat, long, geohash FROM coord_hash")
def geohash(spark, root):
    coords = _logs(spark, root).select("lat", "long").distinct()
    return coords.select("lat", "long", geo.geohash(
        to_double(F.col("lat")), to_double(F.col("long"))).alias("geohash"))


cte("answers", f"SELECT lat, long, {ANSWER} AS answer FROM coords")
cte("businesses", """
SELECT lat, long, CASE WHEN ok AND json_extract_string(answer, '$.status') = '0' THEN
  trim(CASE WHEN coalesce(json_extract_string(answer, '$.result.business'), '') <> ''
       THEN json_extract_string(answer, '$.result.business')
       ELSE array_to_string([t FOR t IN json_extract_string(answer, '$.result.pois[*].tag') IF t <> ''], '') END)
  ELSE '' END AS business FROM (SELECT lat, long, ok, CASE WHEN ok THEN answer ELSE '{}' END AS answer FROM (
    SELECT *, json_valid(answer) AS ok FROM answers))""")


def _answers(spark, root):
    coords = _logs(spark, root).select("lat", "long").distinct()
    return coords.withColumn("answer", F.expr(ANSWER))


@query("business_from_json", "SELECT lat, long, business FROM businesses")
def business_from_json(spark, root):
    return _answers(spark, root).select("lat", "long", geo.business_from_json(F.col("answer")).alias("business"))


@query("geocode_requests", """
SELECT lat, long, '/geocoder/v2/?' || q || '&sn=' || md5(url_encode('/geocoder/v2/?' || q || 'demo-secret')) AS request
FROM (SELECT lat, long, 'location=' || url_encode(lat || ',' || long) || '&output=json&pois=1&ak=demo-key' AS q FROM coords)""")
def geocode_requests(spark, root):
    return geo.geocode_requests(_logs(spark, root), "demo-key", "demo-secret")


@query("geo_business_table", """
SELECT h.geohash, b.business FROM businesses b JOIN coord_hash h ON h.lat = b.lat AND h.long = b.long
WHERE b.business <> ''""")
def geo_business_table(spark, root):
    logs = materialize(_logs(spark, root).select("lat", "long").distinct(), "ad-coords")
    answers = logs.withColumn("answer", F.expr(ANSWER))
    return geo.business_table(logs, answers)
