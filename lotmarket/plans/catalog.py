"""Registry of named queries: each key has a Spark builder and, where the
result is SQL-expressible, the DuckDB oracle text computing the same table.

Builders take ``(spark, sf_dir)`` and return a lazy DataFrame over the driver
tables.  Doubles are rounded to 4 decimals on both sides (sums are exact
decimal sums), integers are BIGINT, months are DATE.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, tuple[Builder, str | None]] = {}

PLAN_MODULES = (
    "lotmarket.plans.market_q",
    "lotmarket.plans.trends_q",
    "lotmarket.plans.scalar_q",
    "lotmarket.plans.relational_q",
    "lotmarket.plans.clean_q",
    "lotmarket.plans.warehouse_q",
    "lotmarket.plans.scoring_q",
    "lotmarket.plans.ml_q",
    "lotmarket.plans.io_q",
    "lotmarket.plans.stream_q",
    "lotmarket.plans.ranking_q",
)


def register(name: str, sql: str | None = None):
    """Register a builder; ``sql=None`` marks a rows-only query."""
    def deco(fn: Builder) -> Builder:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _load() -> None:
    for m in PLAN_MODULES:
        importlib.import_module(m)


def queries() -> dict[str, Builder]:
    _load()
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1] for k, v in _REGISTRY.items() if v[1] is not None}
