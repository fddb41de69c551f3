"""Shared table expressions of the check queries (DuckDB dialect)."""

from .registry import cte

cte("ratings", """
SELECT o_custkey AS userid, l_partkey AS itemid,
       CAST(1 + 0.5 * (CAST(sum(l_quantity) AS BIGINT) % 9) AS DOUBLE) AS rate,
       max(CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT)) AS ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""")

cte("items", """
SELECT p_partkey AS itemid,
       CASE WHEN p_partkey % 11 = 0 THEN p_name
            ELSE p_name || ' (' || CAST(1950 + p_partkey % 70 AS VARCHAR) || ')' END AS title,
       p_type || '|' || upper(string_split(p_name, ' ')[2]) AS genre
FROM part""")

cte("tags", """
SELECT itemid, tag FROM (
  SELECT l_partkey AS itemid, CASE l_linenumber
    WHEN 1 THEN string_split(p_name, ' ')[1]
    WHEN 2 THEN string_split(p_name, ' ')[2]
    WHEN 3 THEN p_name
    WHEN 4 THEN lower(p_type)
    WHEN 5 THEN lower(p_type) || ' ' || CAST(p_size % 10 AS VARCHAR)
    WHEN 6 THEN lower(p_brand)
    WHEN 7 THEN p_name || ' ' || lower(p_type) || ' ' || lower(p_brand) || ' size ' || CAST(p_size AS VARCHAR)
    END AS tag
  FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE tag IS NOT NULL""")

cte("capped", """
SELECT userid, itemid, rate FROM (
  SELECT *, row_number() OVER (PARTITION BY userid ORDER BY rate DESC, itemid) AS rk FROM ratings)
WHERE rk <= 30""")

cte("counted", """
SELECT *, count(*) OVER (PARTITION BY userid) AS n_user,
       count(*) OVER (PARTITION BY itemid) AS n_item FROM ratings""")

for entity, by, short in (("itemid", "userid", "item"), ("userid", "itemid", "user")):
    cte(f"{short}_pairs", f"""
SELECT l.{entity} AS a, r.{entity} AS b, count(*) AS size, sum(l.rate * r.rate) AS dot,
       sum(l.rate) AS sx, sum(r.rate) AS sy, sum(l.rate * l.rate) AS sxx,
       sum(r.rate * r.rate) AS syy, max(l.n_{short}) AS na, max(r.n_{short}) AS nb
FROM counted l JOIN counted r ON l.{by} = r.{by} AND l.{entity} < r.{entity} GROUP BY 1, 2""", stored=True)
    cte(f"{short}_near", f"""
SELECT a, b, sim FROM (
  SELECT a, b, sim, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS rk FROM (
    SELECT a, b, round(dot / (sqrt(sxx) * sqrt(syy)) * size / (na * log10(nb + 10)), 9) AS sim
    FROM (SELECT a, b, size, dot, sxx, syy, na, nb FROM {short}_pairs
          UNION ALL SELECT b, a, size, dot, syy, sxx, nb, na FROM {short}_pairs)))
WHERE rk <= 50""", stored=True)
    cte(f"{short}_kept", f"""
SELECT p.* FROM {short}_pairs p JOIN (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM {short}_near) n
ON p.a = n.a AND p.b = n.b""")

cte("splits", """
SELECT *, CASE WHEN ts % 10 < 6 THEN 'train' WHEN ts % 10 < 8 THEN 'validation' ELSE 'test' END AS split
FROM ratings""")

cte("predicted", """
SELECT t.userid, t.itemid, t.rate, m.prediction FROM (SELECT * FROM splits WHERE split = 'test') t
LEFT JOIN (SELECT itemid, avg(rate) AS prediction FROM splits WHERE split = 'train' GROUP BY 1) m
ON t.itemid = m.itemid""")

cte("avg_rates", "SELECT itemid, round(avg(rate), 1) AS avg_rate FROM ratings GROUP BY 1")
