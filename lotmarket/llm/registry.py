"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

#: Modules with a query of their own: each has QUERIES and may have SQL.
MODULES = ("url_query", "chat_query", "jaccard_query", "decontaminate_query", "token_query", "language_query", "piece_query", "line_query", "quality_query", "suffix_query",
           "recipe_query", "merkle_query", "audit_query")


def queries() -> dict[str, Query]:
    return {k: v for m in MODULES for k, v in import_module(f"lotmarket.llm.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in getattr(import_module(f"lotmarket.llm.{m}"), "SQL", {}).items()}
