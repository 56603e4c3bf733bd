"""Helpers shared by the query plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_binary(c, digits: int = 4):
    """Round half away from zero on the binary value scaled by 10^digits.

    Spark's ``round`` rounds the shortest decimal string of a double, DuckDB
    and NumPy round the binary product ``x * 10^d``; this form agrees with the
    latter, so both engines print the same digits.
    """
    m = float(10 ** digits)
    return F.round(c * F.lit(m), 0) / F.lit(m)


def finish(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column (both engines sum in different orders)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(round_binary(F.col(f.name), digits).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
