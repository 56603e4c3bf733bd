"""op6_line_dedup: lines that five documents or more hold, over the whole table ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmarket.llm.common import table
from lotmarket.llm.line_dedup import dedup_lines


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES = {"op6_line_dedup": op6_line_dedup}

SQL = {"op6_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS place
  FROM documents),
keyed AS (
  SELECT doc_id, place, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
heavy AS (
  SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.doc_id, k.place, k.line, h.key IS NOT NULL AND k.doc_id <> h.owner AS dropped
  FROM keyed k LEFT JOIN heavy h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN dropped THEN NULL ELSE line END, chr(10) ORDER BY place), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""}
