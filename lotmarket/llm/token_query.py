"""op5_token_count: tokens of every text of ``documents`` by a public vocabulary."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lotmarket.llm.common import table
from lotmarket.llm.token_count import counted


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return counted(docs, public_tokenizers.path("word_bpe_49k.json"), carry=["doc_id"])


QUERIES = {"op5_token_count": op5_token_count}
