"""op10_suffix_dedup: repeated strings of 400 bytes taken out of the whole table ``documents``.

Beyond the digest columns the result has ``has_repeats`` and ``kept_text``, what is left as a text (a character of which
some bytes went becomes U+FFFD there; the digest is of the bytes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmarket.llm.common import table
from lotmarket.llm.suffix_dedup import without_repeats


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs, carry=["doc_id"]).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_removed") > 0).alias("has_repeats"), F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"))


QUERIES = {"op10_suffix_dedup": op10_suffix_dedup}
