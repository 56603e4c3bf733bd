"""A corpus, from raw documents to piece ids: five stages, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.  ``docs`` has the columns of the
table ``documents``; all stages but the last return the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmarket.llm import decontaminate, jaccard_join, line_dedup, piece_transducer, quality_rules
from lotmarket.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.judge(docs).where("kept").select(*docs.columns)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents hold go from all but one of them; ``n_chars`` follows the text."""
    rows = line_dedup.dedup_lines(docs).withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("text").cast("long"))
    return rows.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays."""
    return jaccard_join.one_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go, also those without an id."""
    return decontaminate.without(docs, decontaminate.matches(docs, table(spark, sf_dir, "benchmark")), unnamed=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become piece ids."""
    carry = [c for c in docs.columns if c != "text"]
    return piece_transducer.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), carry=carry)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", keep_good),
    ("line dedup", drop_common_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("SentencePiece encoding", encode),
]

#: SimHash windows and the piece transducer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.lower().replace(" ", "-"))
    return docs
