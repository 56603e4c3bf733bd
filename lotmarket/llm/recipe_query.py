"""op11_exact_dedup: equal texts of the whole table ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotmarket.llm.chunk_recipes import exact_groups
from lotmarket.llm.common import table


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])


QUERIES = {"op11_exact_dedup": op11_exact_dedup}

SQL = {"op11_exact_dedup": """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""}
