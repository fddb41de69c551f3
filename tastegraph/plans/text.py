"""Titles, genres, keywords and tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import keywords, tags
from ..sources.tables import load_items, load_ratings, load_tags, table
from . import base_sql, text_sql  # noqa: F401
from .registry import query

# The pattern of the year in a title.
YEAR = r"regexp_extract(title, '.* \(([1-9][0-9][0-9][0-9])\).*', 1)"


@query("title_year", f"""
SELECT itemid, title, coalesce(TRY_CAST(nullif({YEAR}, '') AS INTEGER), 1994) AS year FROM items""")
def title_year(spark, root):
    return load_items(spark, root).select("itemid", "title", X.title_year(F.col("title")).alias("year"))


@query("genre_tokens", """
SELECT itemid, array_to_string(string_split(genre, '|')[1:10], ';') AS tokens,
       len(string_split(genre, '|')[1:10]) AS n FROM items""")
def genre_tokens(spark, root):
    tokens = X.genre_tokens(F.col("genre"))
    return load_items(spark, root).select("itemid", F.array_join(tokens, ";").alias("tokens"),
                                          F.size(tokens).cast("bigint").alias("n"))


@query("keywords_textrank", """
SELECT d.doc_id, k.keywords FROM documents d JOIN dx_kw k ON k.text = d.text""")
def keywords_textrank(spark, root):
    docs = table(spark, root, "documents", "doc_id", "text")
    return keywords.attach_keywords(docs, "text").select("doc_id", "keywords")


@query("title_keywords", "SELECT itemid, keywords FROM items JOIN tt_kw ON text = title")
def title_keywords(spark, root):
    items = load_items(spark, root).select("itemid", "title")
    return keywords.attach_keywords(items, "title", k=10).select("itemid", "keywords")


@query("tag_standardize", "SELECT tag, std FROM tag_std")
def tag_standardize(spark, root):
    return tags.standardized(load_tags(spark, root).select("tag").distinct())


@query("tag_merge", "SELECT tag, final FROM tag_final")
def tag_merge(spark, root):
    return tags.tag_mapping(tags.tag_counts(load_tags(spark, root)))


@query("item_tag_weights", "SELECT itemid, tag, w FROM clean_tags")
def item_tag_weights(spark, root):
    return tags.clean_tag_counts(load_tags(spark, root))


@query("item_tag_map", """
SELECT itemid, string_agg(tag || '=' || w, '; ' ORDER BY tag) AS tag_map, count(*) AS n
FROM item_tags GROUP BY 1""")
def item_tag_map(spark, root):
    maps = tags.item_tag_map(tags.item_weights(tags.clean_tag_counts(load_tags(spark, root))))
    entries = F.transform(F.map_entries("tag_map"), lambda e: F.concat_ws(
        "=", e["key"], e["value"].cast("string")))
    return maps.select("itemid", F.array_join(entries, "; ").alias("tag_map"),
                       F.size("tag_map").cast("bigint").alias("n"))


@query("item_avg_rate", "SELECT itemid, avg_rate FROM avg_rates")
def item_avg_rate(spark, root):
    return load_ratings(spark, root).groupBy("itemid").agg(
        F.round(F.avg("rate"), 1).alias("avg_rate"))
