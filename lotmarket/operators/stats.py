"""Exact quantiles in two passes, without shuffling the rows.

Spark's ``percentile``/``median`` is exact but keeps a value->count map per group
in a single task: fine for many bounded groups, not for one group holding a
third of 100 TB.  ``group_quantiles(method="counted")`` computes the same exact,
linearly interpolated quantiles in two passes over the rows:

1. values fall into *bins* of 0.07 percent relative width (1024 to a factor of
   two).  Rows are counted per (group, bin), combined in each task before the
   shuffle: at most a few thousand rows a task and group, whatever the number of
   rows.  Running counts over a group's bins give the bin of each wanted rank;
2. the rows are read again, and only those of these bins are kept: two bins a
   group and probability at most, some 0.1 percent of the rows each where values
   spread.  They are counted per value and ranked inside their bin.

The bins wanted are written and counted; up to ``BROADCAST_ROWS`` they are
broadcast, so pass 2 shuffles only what it keeps.  Beyond (very many groups) rows
are counted per (group, value) first, ties as one row, and meet the bins by an
ordinary join.  Where reading the rows again would repeat a shuffle (a join or an
aggregate below), the key and value columns are written before pass 1.

All probabilities share both passes, nothing is collected into arrays, and groups
of every size take the same path.  ``method="exact"`` is Spark's ``percentile``;
``method="approx"`` is ``percentile_approx`` (not interpolated, for dashboards that
accept it).  All methods skip NULLs like pandas.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotmarket.operators.common import BROADCAST_ROWS
from lotmarket.sources.files import materialize, materialize_counted

DEFAULT_METHOD = "counted"
DEFAULT_ACCURACY = 100_000


def _keys(keys: str | Sequence[str] | None) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def quantile_exprs(value: str, probs: Mapping[str, float]) -> list:
    """Aggregate expressions for Spark's exact quantile (one pass, per-group map)."""
    return [F.percentile(F.col(value), F.lit(float(p))).alias(name) for name, p in probs.items()]


def group_quantiles(df: DataFrame, keys: str | Sequence[str] | None, value: str,
                    probs: Mapping[str, float], method: str | None = None,
                    accuracy: int = DEFAULT_ACCURACY, count: str | None = None,
                    with_n: str | None = None) -> DataFrame:
    """One row per group: ``keys`` + one column per entry of ``probs``.

    ``count`` names a column that says how often a row counts; ``with_n`` names a column for the group's number of
    non-NULL values (both for the default method only).

    Groups whose values are all NULL are absent (as with ``dropna`` before a
    pandas ``groupby().quantile``).
    """
    method = method or DEFAULT_METHOD
    ks = _keys(keys)
    times = F.col(count).cast("bigint") if count else F.lit(1).cast("bigint")
    base = df.select(*ks, F.col(value).cast("double").alias("_v"), times.alias("_t")).where(F.col("_v").isNotNull())
    if (count or with_n) and method != "counted":
        raise ValueError("counts need the default method")
    if method == "exact":
        return base.groupBy(*ks).agg(*quantile_exprs("_v", probs))
    if method == "approx":
        return base.groupBy(*ks).agg(*[
            F.percentile_approx("_v", float(p), accuracy).alias(n) for n, p in probs.items()])
    if method != "counted":
        raise ValueError(f"unknown quantile method {method!r}")
    if not ks:
        return _counted(base.withColumn("_g", F.lit(0)), ["_g"], probs, with_n).drop("_g")
    return _counted(base, ks, probs, with_n)


BINS_PER_OCTAVE = 1024


def _bin(v: Column) -> Column:
    """A number that grows with the value; values of one bin differ by 0.07 percent at most."""
    size = F.floor((F.log2(F.abs(v)) + 1100) * BINS_PER_OCTAVE)
    top = 1 << 40  # infinities, and above them NaN, as Spark orders them
    return (F.when(F.isnan(v), 2 * top).when(F.abs(v) == float("inf"), F.signum(v) * top)
            .when(v == 0, 0).otherwise(F.signum(v) * size).cast("bigint"))


_SHUFFLES = re.compile(r"\b(Join|Aggregate|Window|Sort|Distinct|Repartition\w*|RebalancePartitions|Intersect|Except)\b")


def reread(df: DataFrame) -> DataFrame:
    """``df`` for more than one reading: written first if each would repeat a shuffle, else as it is."""
    return materialize(df, "quantile-rows") if _SHUFFLES.search(df._jdf.queryExecution().optimizedPlan().toString()) else df


def wanted_bins(binned: DataFrame, ks: list[str], probs: Mapping[str, float]) -> tuple[DataFrame, int]:
    """Pass 1: (``ks``, ``_b``, ``_off`` values below the bin, ``_n`` values of the group) for each bin that holds a wanted
    rank, as a written table; and its number of rows."""
    bins = binned.groupBy(*ks, "_b").agg(F.sum("_t").alias("_c"))
    group = Window.partitionBy(*ks)
    before = F.sum("_c").over(group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    bins = bins.select(*ks, "_b", F.coalesce(before, F.lit(0)).alias("_off"), F.col("_c").alias("_in"), F.sum("_c").over(group).alias("_n"))
    hit = F.lit(False)
    for ranks in _ranks(probs)[1].values():
        for rank in ranks:
            hit = hit | _inside(rank, F.col("_off"), F.col("_in"))
    return materialize_counted(bins.where(hit).drop("_in"), "quantile-bins")


def _ranks(probs: Mapping[str, float]) -> tuple[dict[str, Column], dict[str, tuple[Column, Column]]]:
    """Each probability's place among ``_n`` values, and the ranks on either side of it."""
    place = {n: (F.col("_n") - 1) * F.lit(float(p)) for n, p in probs.items()}
    return place, {n: (F.floor(x).cast("bigint"), F.ceil(x).cast("bigint")) for n, x in place.items()}


def _inside(rank: Column, low: Column, size: Column) -> Column:
    return (low <= rank) & (rank < low + size)


def values_near(binned: DataFrame, ks: list[str], bins: DataFrame, n_bins: int) -> DataFrame:
    """Pass 2: the values of the wanted bins with their counts ``_c``."""
    if n_bins <= BROADCAST_ROWS:
        kept = binned.join(F.broadcast(bins), [*ks, "_b"])
        return kept.groupBy(*ks, "_b", "_off", "_n", "_v").agg(F.sum("_t").alias("_c"))
    return binned.groupBy(*ks, "_b", "_v").agg(F.sum("_t").alias("_c")).join(bins, [*ks, "_b"])


def _counted(base: DataFrame, ks: list[str], probs: Mapping[str, float], with_n: str | None = None) -> DataFrame:
    """Quantiles of ``base`` (``ks``, non-null ``_v``, ``_t`` times)."""
    binned = reread(base).withColumn("_b", _bin(F.col("_v")))
    near = values_near(binned, ks, *wanted_bins(binned, ks, probs))
    place, wanted = _ranks(probs)
    run = Window.partitionBy(*ks, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn("_low", F.col("_off") + F.coalesce(F.sum("_c").over(run), F.lit(0)))
    found = []
    for n, ranks in wanted.items():
        for side, rank in zip("ab", ranks):
            found.append(F.max(F.when(_inside(rank, F.col("_low"), F.col("_c")), F.col("_v"))).alias(f"_{side}_{n}"))
    picked = near.groupBy(*ks).agg(F.max("_n").alias("_n"), *found)
    return picked.select(*ks, *([F.col("_n").cast("bigint").alias(with_n)] if with_n else []), *[
        F.when(F.col(f"_a_{n}") == F.col(f"_b_{n}"), F.col(f"_a_{n}"))
        .otherwise(F.col(f"_a_{n}") + (x - F.floor(x)) * (F.col(f"_b_{n}") - F.col(f"_a_{n}"))).alias(n)
        for n, x in place.items()])


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float],
                     method: str | None = None, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Global quantiles of several columns in one pass: the columns are unpivoted
    to ``(variable, value)`` and treated as groups.  Returns one row with a
    column ``{name}__{column}`` per (probability, column)."""
    long = df.select(F.lit(0).alias("_id"), *[F.col(c).cast("double").alias(c) for c in columns]) \
        .unpivot("_id", list(columns), "_var", "_val")
    q = group_quantiles(long, "_var", "_val", probs, method=method, accuracy=accuracy)
    return q.agg(*[F.max(F.when(F.col("_var") == c, F.col(n))).alias(f"{n}__{c}") for n in probs for c in columns])


def median_exact(value: str):
    """Aggregate expression: exact interpolated median (Spark's ``median``)."""
    return F.median(F.col(value))
