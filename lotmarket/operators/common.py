"""Attaching one-row statistics to rows without a join.

A one-row aggregate (a global median, a fitted coefficient row, a min/max
range) is turned into a scalar subquery: Spark computes it once, inlines the
value and keeps the data side's plan free of nested-loop or cartesian joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows up to which a table of statistics or keys is broadcast.
BROADCAST_ROWS = 100_000
#: Parts into which a hot key's rows are dealt where the small side has more rows than that.
SALTS = 32


def one_row(row: DataFrame) -> Column:
    """The single row of ``row`` as a struct-valued scalar subquery (NULL if empty)."""
    return row.select(F.struct(*[F.col(c) for c in row.columns]).alias("_s")).scalar()


def attach(df: DataFrame, row: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Add the columns of a one-row frame to every row of ``df``.

    The struct lands in one column first and is expanded from there, so the
    plan holds a single subquery (reading ``s[c]`` per field would plan one
    subquery per field)."""
    cols = list(columns or row.columns)
    return df.withColumn("_one_row", one_row(row)).select(
        *df.columns, *[F.col(f"_one_row.{c}").alias(c) for c in cols])


def merge_rows(*rows: DataFrame) -> DataFrame:
    """Combine one-row frames side by side into one row."""
    out = rows[0]
    for r in rows[1:]:
        out = attach(out, r)
    return out


def join_small(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left",
               bound: int = BROADCAST_ROWS, null_safe: bool = False) -> DataFrame:
    """Join rows to a table with one row per key, without dealing the rows out by their (few, hot) keys.

    The small side is written and its rows are counted.  Up to ``bound`` rows it is broadcast; beyond, both sides
    carry a salt, so a key's rows meet ``SALTS`` copies of its one row in as many tasks.  ``small`` has the key
    columns and new ones; ``null_safe`` lets NULL keys meet.
    """
    from lotmarket.sources.files import materialize_counted

    small, n = materialize_counted(small, "small-side")
    names = {k: f"_key_{k}" for k in keys}
    small = small.withColumnsRenamed(names)
    match = lambda a, b: F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b)
    cond = None
    for k, renamed in names.items():
        cond = match(k, renamed) if cond is None else cond & match(k, renamed)
    if n <= bound:
        return df.join(F.broadcast(small), cond, how).drop(*names.values())
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
    copies = small.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    # Spark would judge the copies by the size of the file they come from, and broadcast them
    return salted.join(copies.hint("merge"), cond & (F.col("_salt") == F.col("_copy")), how).drop("_salt", "_copy", *names.values())
