"""The 85-column advertising log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import to_double, to_int
from ..functions.text import literal_pattern

# Log columns in file order.
AD_LOG_DDL = """
sessionid string, advertisersid int, adorderid int, adcreativeid int, adplatformproviderid int,
sdkversion string, adplatformkey string, putinmodeltype int, requestmode int, adprice double,
adppprice double, requestdate string, ip string, appid string, appname string, uuid string,
device string, client int, osversion string, density string, pw int, ph int, long string,
lat string, provincename string, cityname string, ispid int, ispname string, networkmannerid int,
networkmannername string, iseffective int, isbilling int, adspacetype int, adspacetypename string,
devicetype int, processnode int, apptype int, district string, paymode int, isbid int,
bidprice double, winprice double, iswin int, cur string, rate double, cnywinprice double,
imei string, mac string, idfa string, openudid string, androidid string, rtbprovince string,
rtbcity string, rtbdistrict string, rtbstreet string, storeurl string, realip string,
isqualityapp int, bidfloor double, aw int, ah int, imeimd5 string, macmd5 string, idfamd5 string,
openudidmd5 string, androididmd5 string, imeisha1 string, macsha1 string, idfasha1 string,
openudidsha1 string, androididsha1 string, uuidunknow string, userid string, iptype int,
initbidprice double, adpayment double, agentrate double, lomarkrate double, adxrate double,
title string, keywords string, tagid string, callbackdate string, channelid string, mediatype int
"""
AD_LOG_FIELDS = [tuple(part.split()) for part in AD_LOG_DDL.split(",")]
_TYPES = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}
AD_LOG_SCHEMA = T.StructType([T.StructField(n, _TYPES[k]) for n, k in AD_LOG_FIELDS])


def parse_ad_logs(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Typed log rows from a ``value`` column; lines with too few fields are dropped.

    A numeric field that does not parse is 0.
    """
    parts = F.split("value", literal_pattern(sep), -1)
    convert = {"int": to_int, "double": to_double, "string": lambda c: c}
    # as the output of a generator the array is made once; a filter on a plain column would be
    # moved below and split every line a second time
    fields = lines.select(F.explode(F.array(parts)).alias("f")).where(F.size("f") >= len(AD_LOG_FIELDS))
    return fields.select(*[convert[k](F.col("f")[i]).alias(n)
                           for i, (n, k) in enumerate(AD_LOG_FIELDS)])


def read_ad_logs(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return parse_ad_logs(spark.read.text(path), sep)
