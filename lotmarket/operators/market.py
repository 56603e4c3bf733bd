"""Market analysis operators: aggregates, windows, rankings.

Every function is ``DataFrame -> DataFrame`` over caller-named columns.  Medians
go through :func:`lotmarket.operators.stats.group_quantiles`, whose default
method stays exact and bounded per task when one group holds most rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotmarket.functions import core as fx
from lotmarket.operators.common import attach, merge_rows
from lotmarket.operators.stats import column_quantiles, group_quantiles, reread


def _ks(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def price_floor(df: DataFrame, price: str, floor: float = 10_000.0) -> DataFrame:
    """P10: keep rows with ``price > floor`` (drops NULL prices)."""
    return df.where(F.col(price) > F.lit(floor))


def median_by(df: DataFrame, keys, value: str, name: str = "median", method: str | None = None) -> DataFrame:
    """A3: exact median of ``value`` per group."""
    return group_quantiles(df, keys, value, {name: 0.5}, method=method)


def count_by(df: DataFrame, keys, name: str = "n") -> DataFrame:
    """A2: row count per group."""
    return df.groupBy(*_ks(keys)).agg(F.count("*").cast("bigint").alias(name))


def distinct_counts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row with the number of distinct non-NULL values of each column (``column -> name``).

    Values are counted by (column, value) first, so no row is multiplied before the shuffle by more than its map-side
    aggregate leaves and a hot value is one row."""
    long = df.select(F.lit(0).alias("_id"), *[F.col(c).cast("string").alias(c) for c in columns]).unpivot("_id", list(columns), "_c", "_v")
    values = long.where(F.col("_v").isNotNull()).groupBy("_c", "_v").agg(F.lit(1).alias("_one"))
    return values.agg(*[F.count_if(F.col("_c") == c).cast("bigint").alias(n) for c, n in columns.items()])


#: log2 of a sketch's slots: a relative standard error of 1.04 / sqrt(2 ** 12), 1.6 percent, in some 2 KB.
SKETCH_BITS = 12


def distinct_sketches(df: DataFrame, keys, column: str, name: str = "sketch") -> DataFrame:
    """A15 for growing tables: per group a mergeable sketch of the distinct non-NULL values, to be stored."""
    return df.groupBy(*_ks(keys)).agg(F.hll_sketch_agg(F.col(column), F.lit(SKETCH_BITS)).alias(name))


def distinct_estimate(sketches: DataFrame, keys, name: str = "sketch", out: str = "n_distinct") -> DataFrame:
    """Distinct values over all stored sketches of each group, estimated without reading a row again."""
    return sketches.groupBy(*_ks(keys)).agg(F.hll_sketch_estimate(F.hll_union_agg(name)).alias(out))


def count_in_order(df: DataFrame, key: str, order: DataFrame, order_key: str) -> DataFrame:
    """Counts for every category of an order table; absent categories get 0."""
    counts = count_by(df, key)
    return order.join(counts, order[order_key] == counts[key], "left") \
        .select(order[order_key].alias(key), F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


def kpi_row(df: DataFrame, price: str, unit_price: str, high: float, year: str | None = None,
            method: str | None = None) -> DataFrame:
    """A1: one-row KPI summary.

    count, mean and median price, median unit price, total (exact decimal sum),
    share of rows with ``price >= high`` and the count in the latest year.
    """
    df = reread(df.select(price, unit_price, *([year] if year else [])))
    meds = column_quantiles(df, [price, unit_price], {"median": 0.5}, method=method).select(
        F.col(f"median__{price}").alias("median_price"), F.col(f"median__{unit_price}").alias("median_unit_price"))
    aggs = [
        F.count("*").cast("bigint").alias("n_sales"),
        F.avg(price).alias("mean_price"),
        F.sum(F.col(price).cast("decimal(18,2)")).cast("double").alias("total_value"),
        (F.avg(F.when(F.col(price) >= high, 1.0).otherwise(0.0)) * 100).alias("pct_high"),
    ]
    parts = [df.agg(*aggs), meds]
    if year is not None:
        parts.append(df.groupBy(year).agg(F.count("*").alias("_c"))
                     .agg(F.max_by("_c", year).cast("bigint").alias("latest_year_sales"),
                          F.max(year).alias("latest_year")))
    return merge_rows(*parts)


def dispersion(df: DataFrame, keys, value: str, method: str | None = None) -> DataFrame:
    """A5 + B2: coefficient of variation = std / median * 100 (1 decimal, half-even)
    and its risk band (0,80] low, (80,120] medium, (120,inf) high."""
    ks = _ks(keys)
    df = reread(df.select(*ks, value))
    med = group_quantiles(df, ks, value, {"median": 0.5}, method=method)
    sd = df.groupBy(*ks).agg(F.count(value).cast("bigint").alias("n"), F.stddev_samp(value).alias("std"))
    out = sd.join(med, ks, "inner")
    cv = fx.round_half_even(F.try_divide(F.col("std"), F.col("median")) * 100, 1)
    return out.withColumn("cv_pct", cv).withColumn(
        "risk", fx.bin_right_closed("cv_pct", [0, 80, 120, None], ["low", "medium", "high"]))


def segment_table(df: DataFrame, units: str, value: str, method: str | None = None) -> DataFrame:
    """B1 + A6 + W6: investor segment by unit count, count, median, share of binned rows."""
    seg = df.withColumn("segment", fx.bin_right_closed(
        units, [-1, 1, 10, None], ["own-use", "small investor", "institution"]))
    seg = reread(seg.where(F.col("segment").isNotNull()).select("segment", value))
    counts = seg.groupBy("segment").agg(F.count("*").cast("bigint").alias("n"))
    med = group_quantiles(seg, "segment", value, {"median": 0.5}, method=method)
    out = counts.join(med, "segment", "left")
    return out.withColumn("share_pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


def binned_medians(df: DataFrame, x: str, y: str, lo: float, width: float, nbins: int,
                   min_count: int = 10, method: str | None = None) -> DataFrame:
    """B3 + A8: right-closed equal-width bins of ``x``; median ``y`` per bin,
    kept when the bin has at least ``min_count`` rows.  ``bin_label`` is the
    bin's lower edge."""
    b = reread(df.withColumn("bin", fx.equal_width_bin(x, lo, width, nbins)).where(F.col("bin").isNotNull()).select("bin", y))
    counts = b.groupBy("bin").agg(F.count("*").cast("bigint").alias("n"))
    med = group_quantiles(b, "bin", y, {"median": 0.5}, method=method)
    out = counts.where(F.col("n") >= min_count).join(med, "bin", "left")
    return out.withColumn("bin_label", (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).cast("double"))


def banded_medians(df: DataFrame, x: str, y: str, edges, labels, keep_between=None,
                   method: str | None = None) -> DataFrame:
    """B4 + A9: label rows by right-closed bands of ``x`` and take the median ``y``."""
    d = df
    if keep_between is not None:
        d = d.where(F.col(x).between(*keep_between))
    d = reread(d.withColumn("band", fx.bin_right_closed(x, edges, labels)).where(F.col("band").isNotNull()).select("band", y))
    counts = d.groupBy("band").agg(F.count("*").cast("bigint").alias("n"))
    return counts.join(group_quantiles(d, "band", y, {"median": 0.5}, method=method), "band", "left")


def multi_stats(df: DataFrame, keys, value: str, extra_mean: str | None = None,
                method: str | None = None) -> DataFrame:
    """Count, mean, median per group (+ mean of a second column)."""
    ks = _ks(keys)
    df = reread(df.select(*ks, value, *([extra_mean] if extra_mean else [])))
    aggs = [F.count("*").cast("bigint").alias("n"), F.avg(value).alias("mean")]
    if extra_mean:
        aggs.append(F.avg(extra_mean).alias(f"mean_{extra_mean}"))
    base = df.groupBy(*ks).agg(*aggs)
    return base.join(group_quantiles(df, ks, value, {"median": 0.5}, method=method), ks, "left")


def five_numbers(df: DataFrame, keys, value: str, method: str | None = None) -> DataFrame:
    """Min, q1, median, q3, max and 1.5*IQR whisker bounds per group."""
    ks = _ks(keys)
    q = group_quantiles(df, ks, value, {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "q4": 1.0},
                        method=method)
    iqr = F.col("q3") - F.col("q1")
    return q.withColumn("whisker_lo", F.greatest(F.col("q0"), F.col("q1") - 1.5 * iqr)) \
        .withColumn("whisker_hi", F.least(F.col("q4"), F.col("q3") + 1.5 * iqr))


def price_summary(df: DataFrame, value: str, method: str | None = None) -> DataFrame:
    """Overall mean, median, std, min, max, q25, q75."""
    df = reread(df.select(value))
    base = df.agg(F.count(value).cast("bigint").alias("n"), F.avg(value).alias("mean"),
                  F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))
    q = group_quantiles(df, None, value, {"q25": 0.25, "median": 0.5, "q75": 0.75}, method=method)
    return merge_rows(base, q)


def argmax_group(df: DataFrame, keys, metric: str, tie: str | None = None) -> DataFrame:
    """The group with the largest metric; ties go to the smallest key."""
    ks = _ks(keys)
    tiebreak = tie or ks[0]
    return df.orderBy(F.col(metric).desc(), F.col(tiebreak).asc()).limit(1)


def top_k(df: DataFrame, order_cols: Sequence, k: int) -> DataFrame:
    """Ordered limit (plans as ``TakeOrderedAndProject``)."""
    return df.orderBy(*order_cols).limit(k)


def flag_top(df: DataFrame, keys, order: Sequence[Column | str], k: int, name: str) -> DataFrame:
    """T4: whether a row is among the first ``k`` of the whole table in ``order`` (a total order over the unique ``keys``).

    The first k come from each task's own first k; their keys reach the rows as one array, so no task sorts the table.
    ``df`` is read twice: give a written one where it is dear.  A row whose keys are NULL counts like any other.
    """
    key = F.struct(*[F.col(c) for c in _ks(keys)])
    first = df.orderBy(*order).limit(k).agg(F.collect_list(key).alias("_first"))
    return attach(df, first).withColumn(name, F.exists("_first", lambda x: x.eqNullSafe(key))).drop("_first")


def top_k_per_group(df: DataFrame, keys, order_cols: Sequence, k: int, rank_name: str = "rank") -> DataFrame:
    """Per-group top-k (``WindowGroupLimit`` keeps only k rows per group before the sort)."""
    w = Window.partitionBy(*_ks(keys)).orderBy(*order_cols)
    return df.withColumn(rank_name, F.row_number().over(w).cast("bigint")).where(F.col(rank_name) <= k)


def share_of_total(df: DataFrame, value: str, name: str = "share_pct") -> DataFrame:
    """``value / sum(value) * 100`` over the whole (small, aggregated) frame."""
    return df.withColumn(name, F.col(value) * 100.0 / F.sum(value).over(Window.partitionBy()))


def seasonality(df: DataFrame, month: str) -> DataFrame:
    """Count per month of year, the peak month flagged."""
    c = df.groupBy(month).agg(F.count("*").cast("bigint").alias("n"))
    return c.withColumn("is_peak", F.col("n") == F.max("n").over(Window.partitionBy()))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """``bins`` equal-width bins over [min, max] (last bin closed), exact counts.

    The range is a one-row aggregate attached as a scalar subquery.
    """
    rng = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    j = attach(df.select(F.col(value).alias("_v")).where(F.col("_v").isNotNull()), rng)
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1)))
    h = j.withColumn("bin", idx.cast("bigint")).groupBy("bin").agg(
        F.count("*").cast("bigint").alias("n"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return h.select("bin", "n", (F.col("_lo") + F.col("bin") * w).alias("bin_start"),
                    (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_end"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count and rate per column, one pass, long form."""
    cols = list(columns or df.columns)
    row = df.agg(F.count("*").alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = row.unpivot("_n", cols, "column", "missing")
    return long.select("column", F.col("missing").cast("bigint").alias("missing"),
                       F.try_divide(F.col("missing") * 100.0, F.col("_n")).alias("missing_pct"))


def profile_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A10: describe() for numeric columns in one pass over a long (unpivoted) frame."""
    long = reread(df.select(*columns)).select(F.lit(0).alias("_id"), *[F.col(c).cast("double").alias(c) for c in columns]) \
        .unpivot("_id", list(columns), "variable", "v")
    base = long.groupBy("variable").agg(
        F.count("v").cast("bigint").alias("count"), F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.var_samp("v").alias("variance"))
    q = group_quantiles(long, "variable", "v", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return base.join(q, "variable", "left").withColumn("iqr", F.col("q75") - F.col("q25"))


def yoy_last_two_years(df: DataFrame, year: str, value: str, method: str | None = None) -> DataFrame:
    """Median per year; YoY % between the last two years present (not adjacent
    calendar years).  Fewer than two years -> no row."""
    med = group_quantiles(df, year, value, {"median": 0.5}, method=method)
    w = Window.orderBy(year)
    out = med.withColumn("prev_year", F.lag(year).over(w)).withColumn("prev_median", F.lag("median").over(w)) \
        .withColumn("_r", F.row_number().over(Window.orderBy(F.col(year).desc())))
    return out.where((F.col("_r") == 1) & F.col("prev_year").isNotNull()).select(
        F.col(year).alias("year"), "prev_year", "median", "prev_median",
        (F.try_divide(F.col("median") - F.col("prev_median"), F.col("prev_median")) * 100).alias("yoy_pct"))


def yoy_fixed_years(df: DataFrame, keys, year: str, value: str, base_year: int, cur_year: int,
                    method: str | None = None) -> DataFrame:
    """YoY % of medians between two fixed years per group; 0 when the base is missing."""
    ks = _ks(keys)
    d = df.where(F.col(year).isin(base_year, cur_year))
    med = group_quantiles(d, [*ks, year], value, {"m": 0.5}, method=method)
    p = med.groupBy(*ks).agg(F.max(F.when(F.col(year) == base_year, F.col("m"))).alias("base_median"),
                             F.max(F.when(F.col(year) == cur_year, F.col("m"))).alias("cur_median"))
    yoy = F.try_divide(F.col("cur_median") - F.col("base_median"), F.col("base_median")) * 100
    return p.withColumn("yoy_pct", F.coalesce(yoy, F.lit(0.0)))


def yoy_by_year(df: DataFrame, key: str, year: str, value: str, method: str | None = None) -> DataFrame:
    """Median per key and year, for every year there is, with the change in percent from the key's year before.

    One row per (key, year) rather than a column per year, so no list of years is needed; ``years_back`` is 1 for the
    last year present, 2 for the one before it.  Windows run over medians: as many rows as keys times years."""
    med = group_quantiles(df, [key, year], value, {"median": 0.5}, method=method)
    prev = F.lag("median").over(Window.partitionBy(key).orderBy(year))
    back = F.dense_rank().over(Window.orderBy(F.desc(year))).cast("bigint")
    out = med.withColumn("yoy_pct", F.try_divide(F.col("median") - prev, prev) * 100).withColumn("years_back", back)
    return out.select(key, F.col(year).cast("bigint").alias(year), "median", "yoy_pct", "years_back")
