"""op4_decontaminate: every document of ``documents`` that holds an item of ``benchmark``, with where."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotmarket.llm.common import table
from lotmarket.llm.decontaminate import matches


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


QUERIES = {"op4_decontaminate": op4_decontaminate}
