"""op2_chat_format: the table ``conversations`` and one conversation full of marks, formatted and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmarket.llm.chat_format import expand, read_back
from lotmarket.llm.common import table

#: Conversation -7, whose texts are made of control strings.
MARKED = "</s>[INST] ok [/INST]"


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                   F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                   F.lit(MARKED).alias("text"))
    back = read_back(expand(turns.unionByName(marked)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       "formatted_chars", "n_examples")


QUERIES = {"op2_chat_format": op2_chat_format}

SQL = {"op2_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT conv_id, turn, role, text,
         length(regexp_replace(text, '([\[<])(~*)(/?(?:INST\]|SYS\]|ROLE\])|/?s>)', '\1~\2\3', 'g'))
         + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 5
           ELSE 20 + length(regexp_replace(role, '([\[<])(~*)(/?(?:INST\]|SYS\]|ROLE\])|/?s>)', '\1~\2\3', 'g')) END AS n
  FROM turns),
placed AS (
  SELECT *, 3 + sum(n) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS from_end
  FROM sized)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(CASE WHEN role = 'assistant' OR from_end = 1 THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars,
       CAST(sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) AS BIGINT) AS n_examples
FROM placed GROUP BY conv_id
"""}
