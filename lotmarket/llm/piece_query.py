"""op8_sentencepiece: piece ids of every text of ``documents``, and whether they decode to it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lotmarket.llm.common import table
from lotmarket.llm.piece_transducer import encoded


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), carry=["doc_id"])


QUERIES = {"op8_sentencepiece": op8_sentencepiece}
