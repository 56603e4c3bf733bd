"""op12_merkle_manifest: root, proofs and tamper check over the whole table ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmarket.llm.chunk_recipes import normalised
from lotmarket.llm.common import table
from lotmarket.llm.merkle_manifest import folded, leaf_digest, manifest, proof_text

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def checked(docs: DataFrame, **how: int) -> DataFrame:
    """Proofs of all rows, and what they say of the rows whose id's crc32 5 divides, with the text's A-Z lower-cased."""
    lowered = F.when(F.col("text").isNotNull(), normalised(F.col("text")))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, leaf_digest([lowered if c == "text" else F.col(c) for c in FIELDS]))
    rows = manifest(docs, FIELDS, carry={"doc_id": F.col("doc_id"), "tampered": tampered}, **how)
    rows = rows.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(table(spark, sf_dir, "documents"))


QUERIES = {"op12_merkle_manifest": op12_merkle_manifest}


def _row(text: str) -> str:
    fields = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in (*FIELDS[:-1], text)]
    return f"sha256({' || '.join(fields)})"


SQL = {"op12_merkle_manifest": f"""
WITH RECURSIVE crc AS (
  SELECT doc_id, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n,
         {_row("text")} AS leaf,
         CASE WHEN crc % 5 = 0 THEN {_row("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
  FROM documents JOIN crc USING (doc_id)),
nodes AS (
  SELECT source, 0 AS level, i, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT source, level + 1, i // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY i)) FROM nodes WHERE n > 1
  GROUP BY source, level, i // 16, n),
subroots AS (
  SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, i, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, i // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 16, n),
paths AS (
  SELECT l.doc_id, x.level, x.i, x.digest, l.i // CAST(pow(16, x.level) AS BIGINT) AS own
  FROM leaves l JOIN nodes x ON x.source IS NOT DISTINCT FROM l.source AND x.n > 1
   AND x.i // 16 = l.i // CAST(pow(16, x.level + 1) AS BIGINT)
  UNION ALL
  SELECT l.doc_id, 1000 + x.level, x.i, x.digest, s.i // CAST(pow(16, x.level) AS BIGINT)
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source JOIN tops x ON x.n > 1
   AND x.i // 16 = s.i // CAST(pow(16, x.level + 1) AS BIGINT)),
steps AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY level) AS k,
         coalesce(string_agg(digest, '' ORDER BY i) FILTER (i < own), '') AS lefts,
         coalesce(string_agg(digest, '' ORDER BY i) FILTER (i > own), '') AS rights
  FROM paths GROUP BY doc_id, level),
folds AS (
  SELECT doc_id, 0::BIGINT AS k, coalesce(tampered, leaf) AS digest FROM leaves
  UNION ALL
  SELECT f.doc_id, s.k, sha256(s.lefts || f.digest || s.rights) FROM folds f JOIN steps s ON s.doc_id = f.doc_id AND s.k = f.k + 1),
proofs AS (SELECT doc_id, sha256(string_agg(lefts || rights, '' ORDER BY k)) AS proof_sha256 FROM steps GROUP BY doc_id),
ends AS (SELECT doc_id, arg_max(digest, k) AS folded_root FROM folds GROUP BY doc_id),
top AS (SELECT digest AS root FROM tops WHERE n = 1)
SELECT l.doc_id, leaf, s.digest AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source JOIN top ON true
JOIN ends e ON e.doc_id = l.doc_id LEFT JOIN proofs p ON p.doc_id = l.doc_id
"""}
