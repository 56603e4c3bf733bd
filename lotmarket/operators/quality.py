"""Data-quality checks: thresholds, reconciliation,
per-source validation, check summaries.  Each returns a small DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


from lotmarket.operators.common import merge_rows


def threshold_violations(df: DataFrame, thresholds: Mapping[str, tuple]) -> DataFrame:
    """Per column, rows outside ``[lo, hi]`` (NULL counts as no violation),
    one pass, long form."""
    row = df.agg(F.lit(0).alias("_id"), *[F.count_if(~F.col(c).between(lo, hi)).alias(c)
                                          for c, (lo, hi) in thresholds.items()])
    return row.unpivot("_id", list(thresholds), "column", "violations").drop("_id") \
        .withColumn("violations", F.col("violations").cast("bigint"))


def reconcile_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Q1: row counts of source and target side by side."""
    a = source.agg(F.count("*").cast("bigint").alias("source_rows"))
    b = target.agg(F.count("*").cast("bigint").alias("target_rows"))
    return merge_rows(a, b).withColumn("ok", F.col("source_rows") == F.col("target_rows"))


def reconcile_sum(source: DataFrame, col_a: str, target: DataFrame, col_b: str, tol: float = 0.01) -> DataFrame:
    """Q2: sums (exact decimals) agree within ``tol`` relative to the source sum."""
    a = source.agg(F.sum(F.col(col_a).cast("decimal(18,2)")).cast("double").alias("source_sum"))
    b = target.agg(F.sum(F.col(col_b).cast("decimal(18,2)")).cast("double").alias("target_sum"))
    j = merge_rows(a, b)
    return j.withColumn("ok", F.abs(F.col("source_sum") - F.col("target_sum")) <= F.lit(tol) * F.abs(F.col("source_sum")))


def check_summary(checks: DataFrame) -> DataFrame:
    """Q5: totals over a ``(check, ok)`` frame."""
    return checks.agg(F.count("*").cast("bigint").alias("checks"),
                      F.count_if(F.col("ok")).cast("bigint").alias("passed"),
                      F.count_if(~F.col("ok")).cast("bigint").alias("failed"))


def validation_report(df: DataFrame, source: str, measures: Sequence[str], duplicate_keys: Sequence[str]) -> DataFrame:
    """Q7: per source: total rows, valid rows (not all ``measures`` missing),
    invalid rows, rows that repeat others in ``duplicate_keys``, and a list of issues."""
    all_missing = None
    for c in measures:
        m = F.col(c).isNull()
        all_missing = m if all_missing is None else all_missing & m
    per = df.groupBy(source).agg(F.count("*").cast("bigint").alias("total"),
                                 F.count_if(all_missing).cast("bigint").alias("invalid"))
    distinct = df.select(source, *duplicate_keys).distinct().groupBy(source).agg(F.count("*").alias("_d"))
    j = per.join(distinct, source, "left")
    j = j.withColumn("valid", F.col("total") - F.col("invalid")) \
        .withColumn("duplicates", (F.col("total") - F.col("_d")).cast("bigint")).drop("_d")
    issues = F.array_compact(F.array(F.when(F.col("invalid") > 0, F.lit("empty rows")),
                                     F.when(F.col("duplicates") > 0, F.lit("duplicate rows"))))
    return j.withColumn("issues", F.array_join(issues, ";"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q8: one row per table with its row count."""
    out = None
    for name, t in tables.items():
        c = t.agg(F.lit(name).alias("table"), F.count("*").cast("bigint").alias("rows"))
        out = c if out is None else out.unionByName(c)
    return out
