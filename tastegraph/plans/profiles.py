"""Content- and portrait-based recommendation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions.text import genre_tokens, title_year
from ..operators import blend, cf, content, portrait, tags
from ..session import materialize
from ..sources.tables import load_items, load_ratings, load_tags
from . import base_sql, text_sql  # noqa: F401
from .registry import cte, query
from .text import YEAR

cte("attrs", f"""
SELECT itemid, title, genre, string_split(genre, '|')[1:10] AS gl,
       coalesce(TRY_CAST(nullif({YEAR}, '') AS INTEGER), 1994) AS year,
       [w FOR w IN string_split(keywords, ' ') IF w <> ''] AS words
FROM items JOIN tt_kw ON text = title""")
cte("feats", """
SELECT a.itemid, a.genre, a.gl, a.year, a.words, r.avg_rate FROM attrs a JOIN avg_rates r ON r.itemid = a.itemid
WHERE a.itemid IN (SELECT itemid FROM item_tags)""")
cte("tag_norm", "SELECT itemid, CAST(sum(w * w) AS DOUBLE) AS s FROM item_tags GROUP BY 1")
LIST_COS = """CASE WHEN len({a}) + len([v FOR v IN {b} IF list_contains({a}, v)]) > 0
 AND len({b}) + len([v FOR v IN {a} IF list_contains({b}, v)]) > 0 THEN
 (len([v FOR v IN {a} IF list_contains({b}, v)]) + len([v FOR v IN {b} IF list_contains({a}, v)]))
 / (sqrt(len({a}) + len([v FOR v IN {b} IF list_contains({a}, v)]))
    * sqrt(len({b}) + len([v FOR v IN {a} IF list_contains({b}, v)]))) ELSE 0.0 END"""
YEAR_SIM = "CASE WHEN abs({a} - {b}) > 10 THEN 0.0 ELSE 1 - abs({a} - {b}) / 10.0 END"
cte("genre_sims", f"""
SELECT a.genre AS ga, b.genre AS gb, {LIST_COS.format(a='a.gl', b='b.gl')} AS s
FROM (SELECT DISTINCT genre, gl FROM attrs) a, (SELECT DISTINCT genre, gl FROM attrs) b""")
cte("word_sims", f"""
SELECT a.words AS wa, b.words AS wb, {LIST_COS.format(a='a.words', b='b.words')} AS s
FROM (SELECT DISTINCT words FROM attrs) a, (SELECT DISTINCT words FROM attrs) b""")
cte("tag_pairs", """
SELECT x, y, 2 * p / (sqrt(na.s + ca) * sqrt(nb.s + cb)) AS s FROM (
  SELECT a.itemid AS x, b.itemid AS y, CAST(sum(a.w * b.w) AS DOUBLE) AS p,
         CAST(sum(a.w * a.w) AS DOUBLE) AS ca, CAST(sum(b.w * b.w) AS DOUBLE) AS cb
  FROM item_tags a JOIN item_tags b ON a.tag = b.tag GROUP BY 1, 2)
JOIN tag_norm na ON na.itemid = x JOIN tag_norm nb ON nb.itemid = y""")


@query("item_features", """
SELECT f.itemid, genre, year, avg_rate AS rate, array_to_string(list_sort(words), ' ') AS words, count(*) AS n_tags
FROM feats f JOIN item_tags t ON t.itemid = f.itemid GROUP BY ALL""")
def item_features(spark, root):
    f = content.item_features(load_ratings(spark, root), load_items(spark, root), load_tags(spark, root))
    return f.select("itemid", "genre", "year", "rate",
                    F.array_join(F.array_sort(F.map_keys("words")), " ").alias("words"),
                    F.size("tags").cast("bigint").alias("n_tags"))


@query("candidate_items", """
SELECT itemid, avg_rate AS rate FROM avg_rates WHERE avg_rate < 3.5 ORDER BY rate DESC, itemid""")
def candidate_items(spark, root):
    rates = load_ratings(spark, root).groupBy("itemid").agg(F.round(F.avg("rate"), 1).alias("rate"))
    return rates.where(F.col("rate") < 3.5).orderBy(F.desc("rate"), F.asc("itemid"))


@query("content_recommend", f"""
SELECT x AS itemid, y AS itemid_re, score FROM (
  SELECT *, row_number() OVER (PARTITION BY x ORDER BY score DESC, y) AS rk FROM (
    SELECT a.itemid AS x, b.itemid AS y, round(
      0.4 * g.s + 0.25 * coalesce(t.s, 0.0) + 0.1 * ({YEAR_SIM.format(a='a.year', b='b.year')})
      + 0.05 * w.s + 0.2 * least(b.avg_rate / 5, 1.0), 9) AS score
    FROM feats a JOIN (SELECT * FROM feats WHERE avg_rate < 3.5) b ON true
    JOIN genre_sims g ON g.ga = a.genre AND g.gb = b.genre
    JOIN word_sims w ON w.wa = a.words AND w.wb = b.words
    LEFT JOIN tag_pairs t ON t.x = a.itemid AND t.y = b.itemid))
WHERE rk <= 20""")
def content_recommend(spark, root):
    return content.recommend(load_ratings(spark, root), load_items(spark, root), load_tags(spark, root))


cte("user_tag_sums", """
SELECT userid, trim(tag) AS tag, sum(rate * w) AS weight FROM ratings r JOIN clean_tags t ON t.itemid = r.itemid
GROUP BY 1, 2""")
# The looser pattern of the year in a title.
cte("user_year_sums", r"""
SELECT userid, CAST(y AS INTEGER) AS year, sum(rate) AS weight FROM ratings r JOIN (
  SELECT itemid, regexp_extract(title, '.*\(([1-9][0-9][0-9][0-9])\).*', 1) AS y FROM items) i
ON i.itemid = r.itemid WHERE y <> '' GROUP BY 1, 2""")
cte("user_genre_sums", """
SELECT userid, genre, sum(rate) AS weight FROM ratings r JOIN items i ON i.itemid = r.itemid GROUP BY 1, 2""")
for kind, n in (("tag", 20), ("year", 10), ("genre", 10)):
    cte(f"top_{kind}", f"""
SELECT userid, {kind}, weight, least(weight / max(weight) OVER (PARTITION BY userid), 1.0) AS sim FROM (
  SELECT *, row_number() OVER (PARTITION BY userid ORDER BY weight DESC, {kind}) AS rk
  FROM user_{kind}_sums) WHERE rk <= {n}""")
cte("portrait_users", """
SELECT userid, sum(weight * weight) AS s FROM top_tag
WHERE userid IN (SELECT userid FROM top_year) AND userid IN (SELECT userid FROM top_genre) GROUP BY 1""")
cte("portrait_items", """
SELECT a.itemid, genre, year, r.rate, n.s FROM attrs a
JOIN (SELECT itemid, avg(rate) AS rate FROM ratings GROUP BY 1) r ON r.itemid = a.itemid
JOIN tag_norm n ON n.itemid = a.itemid WHERE r.rate < 2.5""")


def _clean(spark, root):
    return tags.clean_tag_counts(load_tags(spark, root))


@query("user_portrait", "SELECT userid, tag, weight FROM user_tag_sums ORDER BY userid, weight DESC, tag")
def user_portrait(spark, root):
    return portrait.user_tags(load_ratings(spark, root), _clean(spark, root)).orderBy(
        F.asc("userid"), F.desc("weight"), F.asc("tag"))


@query("profile_tag", "SELECT userid, tag, weight FROM top_tag")
def profile_tag(spark, root):
    return portrait.strongest(portrait.user_tags(load_ratings(spark, root), _clean(spark, root)), "tag", 20)


@query("profile_year", "SELECT userid, year, weight FROM top_year")
def profile_year(spark, root):
    return portrait.strongest(
        portrait.user_years(load_ratings(spark, root), load_items(spark, root)), "year", 10)


@query("profile_genre", "SELECT userid, genre, weight FROM top_genre")
def profile_genre(spark, root):
    return portrait.strongest(
        portrait.user_genres(load_ratings(spark, root), load_items(spark, root)), "genre", 10)


@query("item_attributes", """
SELECT i.itemid, title, genre, round(avg(rate), 6) AS rate FROM items i JOIN ratings r ON r.itemid = i.itemid
GROUP BY 1, 2, 3""")
def item_attributes(spark, root):
    return portrait.item_attributes(load_ratings(spark, root), load_items(spark, root)).withColumn(
        "rate", F.round("rate", 6))


@query("portrait_recommend", """
SELECT userid, itemid, score FROM (
  SELECT *, row_number() OVER (PARTITION BY userid ORDER BY score DESC, itemid) AS rk FROM (
    SELECT u.userid, i.itemid, round(
      0.4 * coalesce(g.sim, 0.0) + 0.3 * coalesce(2 * t.p / (sqrt(u.s + t.ca) * sqrt(i.s + t.cb)), 0.0)
      + 0.1 * coalesce(y.sim, 0.0) + 0.2 * least(i.rate / 5, 1.0), 9) AS score
    FROM portrait_users u JOIN portrait_items i ON true
    LEFT JOIN top_genre g ON g.userid = u.userid AND g.genre = i.genre
    LEFT JOIN top_year y ON y.userid = u.userid AND y.year = i.year
    LEFT JOIN (
      SELECT a.userid, b.itemid, sum(a.weight * b.w) AS p, sum(a.weight * a.weight) AS ca,
             CAST(sum(b.w * b.w) AS DOUBLE) AS cb
      FROM top_tag a JOIN item_tags b ON a.tag = b.tag
      WHERE b.itemid IN (SELECT itemid FROM portrait_items) GROUP BY 1, 2) t
    ON t.userid = u.userid AND t.itemid = i.itemid
    WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.userid = u.userid AND r.itemid = i.itemid)))
WHERE rk <= 20""")
def portrait_recommend(spark, root):
    return portrait.recommend(load_ratings(spark, root), load_items(spark, root), load_tags(spark, root))


def _near_items(spark, root):
    return cf.item_neighbours(materialize(cf.cap(load_ratings(spark, root)), "ratings")).select("a", "b")


def _both(pairs, features):
    side = lambda s: features.select(F.col("itemid").alias(s), F.col("v").alias(f"v_{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b")


@query("sim_list_cosine", f"""
SELECT n.a, n.b, round({LIST_COS.format(a='x.gl', b='y.gl')}, 6) AS sim
FROM item_near n JOIN attrs x ON x.itemid = n.a JOIN attrs y ON y.itemid = n.b""")
def sim_list_cosine(spark, root):
    f = load_items(spark, root).select("itemid", genre_tokens(F.col("genre")).alias("v"))
    return _both(_near_items(spark, root), f).select(
        "a", "b", F.round(S.list_cosine(F.col("v_a"), F.col("v_b")), 6).alias("sim"))


@query("sim_tag_cosine", """
SELECT n.a, n.b, round(coalesce(t.s, 0.0), 6) AS sim
FROM item_near n JOIN tag_norm x ON x.itemid = n.a JOIN tag_norm y ON y.itemid = n.b
LEFT JOIN tag_pairs t ON t.x = n.a AND t.y = n.b""")
def sim_tag_cosine(spark, root):
    maps = tags.item_tag_map(tags.item_weights(_clean(spark, root)))
    f = maps.select("itemid", F.transform_values("tag_map", lambda _, w: w.cast("double")).alias("v"))
    return _both(_near_items(spark, root), f).select(
        "a", "b", F.round(blend.map_cosine(F.col("v_a"), F.col("v_b")), 6).alias("sim"))


@query("sim_year", f"""
SELECT n.a, n.b, round({YEAR_SIM.format(a='x.year', b='y.year')}, 6) AS sim
FROM item_near n JOIN attrs x ON x.itemid = n.a JOIN attrs y ON y.itemid = n.b""")
def sim_year(spark, root):
    f = load_items(spark, root).select("itemid", title_year(F.col("title")).alias("v"))
    return _both(_near_items(spark, root), f).select(
        "a", "b", F.round(S.year(F.col("v_a"), F.col("v_b")), 6).alias("sim"))


@query("sim_rate", "SELECT itemid, round(least(avg(rate) / 5, 1.0), 6) AS sim FROM ratings GROUP BY 1")
def sim_rate(spark, root):
    means = load_ratings(spark, root).groupBy("itemid").agg(F.avg("rate").alias("rate"))
    return means.select("itemid", F.round(S.rate(F.col("rate")), 6).alias("sim"))


@query("sim_profile_key", """
SELECT r.userid, r.itemid, round(coalesce(g.sim, 0.0), 6) AS sim FROM ratings r
JOIN items i ON i.itemid = r.itemid LEFT JOIN top_genre g ON g.userid = r.userid AND g.genre = i.genre""")
def sim_profile_key(spark, root):
    r, items = load_ratings(spark, root), load_items(spark, root)
    sims = portrait.key_similarity(portrait.strongest(portrait.user_genres(r, items), "genre", 10), "genre")
    return (r.select("userid", "itemid").join(items.select("itemid", "genre"), "itemid")
            .join(sims, ["userid", "genre"], "left")
            .select("userid", "itemid", F.round(F.coalesce("sim", F.lit(0.0)), 6).alias("sim")))
