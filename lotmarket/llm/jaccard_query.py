"""op3_jaccard_join: components of near copies over the whole table ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotmarket.llm.common import table
from lotmarket.llm.jaccard_join import link


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents"))


QUERIES = {"op3_jaccard_join": op3_jaccard_join}
