"""op13_filter_audit: five filters in all orders over the whole table ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotmarket.llm.byte_transducer import audit
from lotmarket.llm.common import table


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op13_filter_audit": op13_filter_audit}

SQL = {"op13_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
counted AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
failed AS (
  SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
         {'A': len(ws) < 100, 'B': 100 * len(list_distinct(ws)) < 80 * len(ws),
          'C': 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t),
          'D': regexp_matches(t, '[#$%&*|]'), 'E': doc_id > least} AS f
  FROM counted LEFT JOIN labels USING (doc_id)),
flags AS (
  SELECT part, good, toxic, [f.A, f.B, f.C, f.D, f.E] AS fails,
         f.A::INT + f.B::INT + f.C::INT + f.D::INT + f.E::INT AS n_fails FROM failed),
one AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT p.x || q.x || r.x || s.x || u.x AS filter_order FROM one p, one q, one r, one s, one u
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
grouped AS (SELECT part, fails, n_fails, good, toxic, count(*) AS n FROM flags GROUP BY ALL),
each AS (
  SELECT g.*, filter_order, step,
         fails[ascii(filter_order[step]) - 64] AS hit,
         len(list_filter(range(1, step), lambda k: fails[ascii(filter_order[k]) - 64])) > 0 AS gone
  FROM grouped g, steps)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS BIGINT) AS kept,
       CAST(coalesce(sum(n) FILTER (NOT gone AND hit), 0) AS BIGINT) AS removed,
       CAST(coalesce(sum(n) FILTER (gone AND hit), 0) AS BIGINT) AS redundant,
       CAST(coalesce(sum(n) FILTER (hit AND n_fails = 1), 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(sum(n) FILTER (NOT gone AND hit AND good), 0) AS BIGINT) AS good_lost,
       CAST(coalesce(sum(n) FILTER (NOT gone AND hit AND toxic), 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(n * (120 // greatest(n_fails, 1))) FILTER (hit), 0) AS BIGINT) AS shapley
FROM each GROUP BY part, filter_order, step
"""}
