"""Shared table expressions for keyword and tag checks (DuckDB dialect)."""

from ..operators.keywords import STOP_WORDS
from .registry import cte

STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)


def textrank(prefix: str, source: str, k: int) -> str:
    """Register chained expressions ``{prefix}_kw(text, keywords)`` and return the name.

    ``source`` yields a column ``text``; ten rank rounds are unrolled.
    """
    p = prefix
    cte(f"{p}_texts", f"SELECT row_number() OVER () AS id, text FROM "
                      f"(SELECT DISTINCT text FROM ({source}) WHERE text IS NOT NULL)")
    cte(f"{p}_tok", f"""
SELECT id, w, row_number() OVER (PARTITION BY id ORDER BY p) AS pos FROM (
  SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM (
    SELECT id, regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+') AS ws FROM {p}_texts))
WHERE w <> '' AND w NOT IN ({STOPS})""")
    cte(f"{p}_edge", f"""
SELECT DISTINCT id, u, v FROM (
  SELECT x.id, x.w AS u, y.w AS v FROM {p}_tok x JOIN {p}_tok y
    ON x.id = y.id AND y.pos > x.pos AND y.pos < x.pos + 5 AND x.w <> y.w
  UNION ALL
  SELECT x.id, y.w, x.w FROM {p}_tok x JOIN {p}_tok y
    ON x.id = y.id AND y.pos > x.pos AND y.pos < x.pos + 5 AND x.w <> y.w)""")
    cte(f"{p}_deg", f"SELECT id, u, count(*) AS d FROM {p}_edge GROUP BY 1, 2")
    cte(f"{p}_s0", f"SELECT DISTINCT id, w, 1.0::DOUBLE AS s FROM {p}_tok")
    for i in range(1, 11):
        cte(f"{p}_s{i}", f"""
SELECT s.id, s.w, 0.15::DOUBLE + 0.85::DOUBLE * coalesce(g.t, 0.0::DOUBLE) AS s FROM {p}_s0 s LEFT JOIN (
  SELECT e.id, e.v, sum(o.s / d.d) AS t FROM {p}_edge e
  JOIN {p}_deg d ON d.id = e.id AND d.u = e.u
  JOIN {p}_s{i - 1} o ON o.id = e.id AND o.w = e.u GROUP BY 1, 2) g
ON g.id = s.id AND g.v = s.w""")
    cte(f"{p}_top", f"""
SELECT id, w, s FROM (SELECT id, w, round(s, 9) AS s,
  row_number() OVER (PARTITION BY id ORDER BY round(s, 9) DESC, w) AS rk FROM {p}_s10) WHERE rk <= {k}""")
    cte(f"{p}_kw", f"""
SELECT t.text, coalesce(k.kw, '') AS keywords FROM {p}_texts t LEFT JOIN (
  SELECT id, string_agg(w, ' ' ORDER BY w) AS kw FROM {p}_top GROUP BY 1) k ON k.id = t.id""")
    return f"{p}_kw"


WORDS = "len(string_split(rtrim(tag, ' '), ' '))"
textrank("tg", f"SELECT tag AS text FROM tags WHERE {WORDS} > 3", 20)
textrank("tt", "SELECT title AS text FROM items", 10)
textrank("dx", "SELECT text FROM documents", 20)

cte("tag_std", f"""
SELECT DISTINCT tag, CASE WHEN {WORDS} > 3 THEN k.keywords ELSE tag END AS std
FROM tags LEFT JOIN tg_kw k ON k.text = tags.tag""")
cte("std_words", f"""
SELECT std AS tag, len(string_split(rtrim(std, ' '), ' ')) AS n FROM (SELECT DISTINCT std FROM tag_std)""")
cte("tag_merged", """
SELECT s, l FROM (
  SELECT s.tag AS s, l.tag AS l, row_number() OVER (PARTITION BY s.tag ORDER BY length(l.tag), l.tag) AS rk
  FROM (SELECT tag FROM std_words WHERE n = 1) s JOIN (SELECT tag FROM std_words WHERE n > 1) l
  ON length(s.tag) < length(l.tag)
  AND list_max([CASE WHEN left(s.tag, i) = left(l.tag, i) THEN strlen(left(s.tag, i)) ELSE 0 END
                FOR i IN range(0, length(s.tag) + 1)]) / strlen(l.tag)::DOUBLE >= 0.714)
WHERE rk = 1""")
cte("tag_final", """
SELECT t.tag, coalesce(m.l, t.std) AS final FROM tag_std t LEFT JOIN tag_merged m ON m.s = t.std""")
cte("clean_tags", """
SELECT itemid, final AS tag, CAST(count(*) AS BIGINT) AS w FROM tags t JOIN tag_final f ON f.tag = t.tag GROUP BY 1, 2""")
cte("item_tags", """
SELECT itemid, tag, w FROM (SELECT *, row_number() OVER (PARTITION BY itemid ORDER BY w DESC, tag) AS rk
FROM clean_tags) WHERE rk <= 10""")
