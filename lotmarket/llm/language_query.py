"""op7_language_id: the language of every text of ``documents``, learnt from those that aren't held out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmarket.llm.common import table
from lotmarket.llm.language_id import fit, held_out, predict


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = fit(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()).select("text", "lang"))
    return predict(docs, model, carry=["doc_id", "held_out"])


QUERIES = {"op7_language_id": op7_language_id}
