"""Filters, flags and cleaning operators.

Statistics a cleaning step needs (medians, modes, quartiles, null rates) are
computed in one aggregate and joined back as a one-row frame on a constant
key, so the step stays a single lazy plan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotmarket.operators.common import attach
from lotmarket.operators.stats import column_quantiles, group_quantiles, reread
from lotmarket.sources.files import counts_of, materialize


def _one_row_join(df: DataFrame, row: DataFrame) -> DataFrame:
    """Attach a one-row statistics frame to every row (scalar subquery, no join)."""
    return attach(df, row)


# --------------------------------------------------------------------------- predicates / flags

def slice_filter(df: DataFrame, key: str, values: Sequence, year: str, years: tuple,
                 value: str, bounds: tuple) -> DataFrame:
    """``key IN values AND year BETWEEN AND value BETWEEN`` (inclusive)."""
    return df.where(F.col(key).isin(*values) & F.col(year).between(*years) & F.col(value).between(*bounds))


def trim_quantiles(df: DataFrame, value: str, lo: float, hi: float, method: str | None = None) -> DataFrame:
    """Keep rows between the ``lo`` and ``hi`` quantiles (inclusive); the
    bounds are kept as ``_lo``/``_hi``."""
    q = group_quantiles(df, None, value, {"_lo": lo, "_hi": hi}, method=method)
    return _one_row_join(df, q).where(F.col(value).between(F.col("_lo"), F.col("_hi")))


def trim_upper_within(df: DataFrame, x: str, x_range: tuple, value: str, q: float,
                      method: str | None = None) -> DataFrame:
    """Filter ``x`` to a range, then drop rows at or above the ``q`` quantile
    of ``value`` among the remaining rows."""
    a = df.where(F.col(x).between(*x_range))
    b = group_quantiles(a, None, value, {"_cut": q}, method=method)
    return _one_row_join(a, b).where(F.col(value) < F.col("_cut")).drop("_cut")


def threshold_clean(df: DataFrame, thresholds: Mapping[str, tuple]) -> DataFrame:
    """Drop all-NULL rows, then keep rows inside every ``[lo, hi]`` threshold."""
    out = df.na.drop(how="all")
    for c, (lo, hi) in thresholds.items():
        out = out.where(F.col(c).between(lo, hi))
    return out


def lookup_with_default(df: DataFrame, key: str, table: DataFrame, name: str, default) -> DataFrame:
    """Left join a code-defined label table ``(k, label)`` (broadcast; its
    size is fixed in code) and fill misses with ``default``."""
    t = table.select(F.col("k").alias(f"_lk_{name}"), F.col("label").alias(f"_lv_{name}"))
    j = df.join(F.broadcast(t), F.col(key) == F.col(f"_lk_{name}"), "left")
    return j.withColumn(name, F.coalesce(F.col(f"_lv_{name}"), F.lit(default))) \
        .drop(f"_lk_{name}", f"_lv_{name}")


def flag_below(c: str, k: float) -> Column:
    """Internal-transfer style flag."""
    return F.col(c) < F.lit(k)


def flag_above(c: str, k: float) -> Column:
    return F.col(c) > F.lit(k)


def prefix_flag(c: str, prefix: str) -> Column:
    """P20: 1 when the text starts with ``prefix`` (NULL -> 0)."""
    return F.startswith(F.coalesce(F.col(c), F.lit("")), F.lit(prefix)).cast("int")


def contains_flag(c: str, needle: str) -> Column:
    """1 when the text contains ``needle`` (NULL -> 0)."""
    return F.coalesce(F.col(c).contains(needle), F.lit(False)).cast("int")


def trim_text_columns(df: DataFrame) -> DataFrame:
    """``trim`` every string column in one projection."""
    return df.select(*[F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
                       else F.col(f.name) for f in df.schema.fields])


def normalize_headers(df: DataFrame, style: str = "snake", rename: Mapping[str, str] | None = None) -> DataFrame:
    """Strip + lower + spaces to ``_`` (``snake``) or strip + upper (``upper``),
    then an optional rename map; metadata only."""
    def norm(n: str) -> str:
        s = n.strip()
        return s.lower().replace(" ", "_") if style == "snake" else s.upper()
    out = df.toDF(*[norm(c) for c in df.columns])
    if rename:
        out = out.withColumnsRenamed({k: v for k, v in rename.items() if k in out.columns})
    return out


# --------------------------------------------------------------------------- imputation

def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def impute_median(df: DataFrame, columns: Sequence[str] | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """Fill NULLs of each numeric column with its exact median.

    ``fit_on`` (e.g. the training split) supplies the medians so test rows never
    leak into them; by default the frame itself is used.
    """
    cols = list(columns or numeric_columns(df))
    if fit_on is None:
        df = reread(df)
    src = fit_on if fit_on is not None else df
    meds = column_quantiles(src, cols, {"_med": 0.5})
    j = _one_row_join(df, meds)
    out = [F.coalesce(F.col(c), F.col(f"_med__{c}").cast(df.schema[c].dataType)).alias(c) if c in cols
           else F.col(c) for c in df.columns]
    return j.select(*out)


def impute_mode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill NULLs of text columns with the most frequent value; ties -> smallest.

    Modes come from ``groupBy(col).count()`` per column (partial aggregation, so
    a dominant value costs one row per task) and a top-1 over the counts.
    """
    cols = list(columns or string_columns(df))
    j = df
    for c in cols:
        cnt = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("_n"))
        top = cnt.orderBy(F.desc("_n"), F.asc(c)).limit(1).select(F.col(c).alias(f"_mode_{c}"))
        j = attach(j, top)
    return j.select(*[F.coalesce(F.col(c), F.col(f"_mode_{c}")).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def impute_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Per-column constant fill (``na.fill``)."""
    return df.na.fill(dict(values))


def iqr_clip(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    """C4: clamp each column to ``[Q1 - k*IQR, Q3 + k*IQR]``; rows are kept, NULL stays NULL."""
    df = reread(df)
    stats = column_quantiles(df, columns, {"_q1": 0.25, "_q3": 0.75})
    j = _one_row_join(df, stats)
    out = []
    for c in df.columns:
        if c in columns:
            q1, q3 = F.col(f"_q1__{c}"), F.col(f"_q3__{c}")
            lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
            out.append(F.when(F.col(c).isNull(), None).otherwise(F.least(F.greatest(F.col(c), lo), hi)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def sparse_columns(df: DataFrame, threshold_pct: float = 50.0) -> list[str]:
    """Names of columns whose NULL rate exceeds ``threshold_pct`` (one action;
    the output schema depends on the data, so it cannot stay lazy)."""
    row = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    n = row["_n"] or 0
    return [c for c in df.columns if n and row[c] * 100.0 / n > threshold_pct]


def drop_sparse(df: DataFrame, threshold_pct: float = 50.0) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold_pct))


def degenerate_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: non-NULL count and distinct count; flags all-missing and constant.

    Counted per (column, value) first: a hot value is one row, and no row is multiplied by the number of columns
    beyond its map-side aggregate."""
    cols = list(columns or df.columns)
    long = df.select(F.lit(0).alias("_id"), *[F.col(c).cast("string").alias(c) for c in cols]).unpivot("_id", cols, "column", "_v")
    values = long.groupBy("column", "_v").agg(F.count("_v").alias("_n"))
    per = values.groupBy("column").agg(F.sum("_n").cast("bigint").alias("non_null"), F.count("_v").cast("bigint").alias("distinct"))
    return per.withColumn("all_missing", F.col("non_null") == 0).withColumn("constant", F.col("distinct") == 1)


# --------------------------------------------------------------------------- audit

def _measures(df: DataFrame) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"nulls {c}") for c in df.columns]]


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with its row count and the NULLs of each column, gathered while it is computed for something else."""
    seen = Observation()
    return df.observe(seen, *_measures(df)), seen


def _counts(df: DataFrame, seen: Observation) -> dict[str, int]:
    """What was observed of ``df``; counted anew where Spark left the node out, as it does with all that a step without
    result rows is made from."""
    return counts_of(seen) or df.agg(*_measures(df)).first().asDict()


def drop_sparse_seen(threshold_pct: float) -> Callable[[DataFrame, Mapping[str, int]], DataFrame]:
    """C5 as a step of :func:`audited`: the NULL rates are those observed on its input, so nothing is read for them."""
    def run(df: DataFrame, seen: Mapping[str, int]) -> DataFrame:
        n = seen["rows"]
        return df.drop(*[c for c in df.columns if n and seen[f"nulls {c}"] * 100.0 / n > threshold_pct])
    run.reads_counts = True  # the step before must be complete
    return run


def audited(source: DataFrame, steps: Sequence[tuple[str, Callable]], columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Runs the cleaning steps over one reading of the source: (cleaned rows, audit trail).

    Every step's row count and NULLs are observed while the rows pass through it.  Rows are written where a step needs
    the counts of its input (one that takes them as a second argument), and at the end.  The trail has (step, metric,
    column, before, after) for each step: metrics ``rows``, ``columns``, and ``nulls`` of each of ``columns`` (by default
    all that the rows have before or after the step).
    """
    frame, seen = _observed(source)
    states = [("", source, seen)]
    for name, step in steps:
        if getattr(step, "reads_counts", False):
            frame = materialize(frame, "clean-step")
            following = step(frame, _counts(frame, seen))
        else:
            following = step(frame)
        frame, seen = _observed(following)
        states.append((name, following, seen))
    cleaned = materialize(frame, "cleaned")
    rows = []
    for (_, had, before), (name, has, after) in zip(states, states[1:]):
        a, b = _counts(had, before), _counts(has, after)
        rows += [(name, "rows", None, a["rows"], b["rows"]), (name, "columns", None, len(had.columns), len(has.columns))]
        names = dict.fromkeys([*had.columns, *has.columns]) if columns is None else columns
        rows += [(name, "nulls", c, a.get(f"nulls {c}"), b.get(f"nulls {c}")) for c in names if f"nulls {c}" in {**a, **b}]
    return cleaned, source.sparkSession.createDataFrame(rows, "step string, metric string, column string, before bigint, after bigint")
