"""Geohash, geocoder requests and geocoder answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Geohash alphabet, request path, answer layout.
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"
REQUEST_PATH = "/geocoder/v2/?"
ANSWER_SCHEMA = "status int, result struct<business:string, pois:array<struct<tag:string>>>"


def _cell(value: Column, low: float, width: float, bits: int) -> Column:
    cells = 1 << bits
    raw = F.floor((value - F.lit(low)) / F.lit(width) * F.lit(float(cells))).cast("bigint")
    return F.greatest(F.lit(0), F.least(raw, F.lit(cells - 1)))


def geohash(lat: Column, lon: Column, precision: int = 12) -> Column:
    """Base-32 geohash from integer cell numbers, longitude bit first.

    Each digit picks its five bits straight from the two cell numbers, so the
    expression grows with ``precision`` only and the cells are shared.
    """
    cells = (_cell(lon, -180.0, 360.0, 30), _cell(lat, -90.0, 180.0, 30))

    def digit(i: int) -> Column:
        bits = [F.shiftright(cells[j % 2], 29 - j // 2).bitwiseAND(F.lit(1))
                for j in range(5 * i, 5 * i + 5)]
        value = sum((b * (16 >> n) for n, b in enumerate(bits)), F.lit(1))
        return F.substring(F.lit(BASE32), value.cast("int"), F.lit(1))

    return F.concat(*[digit(i) for i in range(precision)])


def business_from_json(answer: Column) -> Column:
    """Business area, else the joined tags of the places nearby; '' when there is none."""
    a = F.from_json(answer, ANSWER_SCHEMA)
    tags = F.filter(F.transform(a["result"]["pois"], lambda p: p["tag"]),
                    lambda t: t.isNotNull() & (t != ""))
    business = F.coalesce(a["result"]["business"], F.lit(""))
    text = F.when(business != "", business).otherwise(F.coalesce(F.array_join(tags, ""), F.lit("")))
    return F.when(a["status"] == 0, F.trim(text)).otherwise(F.lit(""))


def query_string(pairs: list[tuple[str, Column]]) -> Column:
    """``k=v`` joined by ``&`` in the given order, values URL-encoded."""
    return F.concat_ws("&", *[F.concat(F.lit(f"{k}="), F.url_encode(v)) for k, v in pairs])


def signed(query: Column, secret: str, path: str = REQUEST_PATH) -> Column:
    return F.md5(F.url_encode(F.concat(F.lit(path), query, F.lit(secret))))


def geocode_requests(coords: DataFrame, key: str, secret: str) -> DataFrame:
    """``(lat, long, request)``: one signed request per distinct coordinate."""
    query = query_string([("location", F.concat_ws(",", "lat", "long")), ("output", F.lit("json")),
                          ("pois", F.lit("1")), ("ak", F.lit(key))])
    return coords.select("lat", "long").distinct().withColumn("_q", query).select(
        "lat", "long", F.concat(F.lit(REQUEST_PATH), "_q", F.lit("&sn="),
                                signed(F.col("_q"), secret)).alias("request"))


def business_table(coords: DataFrame, answers: DataFrame) -> DataFrame:
    """``(geohash, business)`` of coordinates whose answer names an area.

    ``coords(lat, long)`` are text as logged, ``answers(lat, long, answer)``
    holds stored geocoder responses.
    """
    from .casts import to_double

    found = coords.select("lat", "long").distinct().join(answers, ["lat", "long"])
    return found.select(
        geohash(to_double(F.col("lat")), to_double(F.col("long"))).alias("geohash"),
        business_from_json(F.col("answer")).alias("business")).where(F.col("business") != "")
