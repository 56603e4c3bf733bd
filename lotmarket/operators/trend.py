"""Statistics, trends and forecasts as grouped aggregates.

No per-group Python loops: a trend per area is a two-level ``groupBy`` (month
medians, then closed-form regression sums per area); forecasts expand a small
per-group result with ``sequence`` + ``explode``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotmarket.functions import core as fx
from lotmarket.operators.common import attach
from lotmarket.operators.stats import group_quantiles


def _ks(keys) -> list[str]:
    return [] if keys is None else ([keys] if isinstance(keys, str) else list(keys))


def safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson r that yields NULL (not an ANSI error) for a constant column.

    Aggregate functions skip rows where either side is NULL (pairwise complete)."""
    xc, yc = fx.col(x), fx.col(y)
    both = xc.isNotNull() & yc.isNotNull()
    xs, ys = F.when(both, xc), F.when(both, yc)
    return F.try_divide(F.covar_samp(xs, ys), F.stddev_samp(xs) * F.stddev_samp(ys))


def r2_guarded(y: Column | str, x: Column | str) -> Column:
    """Regression R^2, 0 when ``y`` is constant (Spark's ``regr_r2`` says 1)."""
    return F.when(F.var_pop(fx.col(y)) == 0, F.lit(0.0)).otherwise(F.regr_r2(fx.col(y), fx.col(x)))


def monthly_medians(df: DataFrame, keys, date: str, value: str, method: str | None = None) -> DataFrame:
    """First level: (keys, month) -> median, n (the values that there are), from one pass over the rows."""
    ks = _ks(keys)
    d = df.withColumn("month", F.trunc(F.col(date), "MM"))
    if method in (None, "counted"):
        return group_quantiles(d, [*ks, "month"], value, {"median": 0.5}, with_n="n")
    med = group_quantiles(d, [*ks, "month"], value, {"median": 0.5}, method=method)
    return d.groupBy(*ks, "month").agg(F.count(value).cast("bigint").alias("n")).join(med, [*ks, "month"], "inner")


def returns_table(series: DataFrame, keys, min_months: int = 3, min_n: int = 10) -> DataFrame:
    """R6 + W1 + R4 + R5: per group: first/last monthly median, % return, linear
    slope per day, guarded R^2, months and rows; groups with too few months or
    rows are dropped."""
    ks = _ks(keys)
    x = F.unix_date(F.col("month")).cast("double")
    out = series.groupBy(*ks).agg(
        F.min_by("median", "month").alias("start"), F.max_by("median", "month").alias("end"),
        F.regr_slope(F.col("median"), x).alias("slope"),
        r2_guarded(F.col("median"), x).alias("r2"),
        F.count("*").cast("bigint").alias("months"), F.sum("n").cast("bigint").alias("n"))
    out = out.where((F.col("months") >= min_months) & (F.col("n") >= min_n))
    return out.withColumn("return_pct", F.try_divide(F.col("end") - F.col("start"), F.col("start")) * 100)


def confidence(n: str = "n", months: str = "months", r2: str = "r2") -> Column:
    """min(n/100*40,40) + min(months/12*30,30) + min(R2*30,30), half-even to 0 decimals."""
    s = (F.least(F.col(n) / 100.0 * 40, F.lit(40.0)) + F.least(F.col(months) / 12.0 * 30, F.lit(30.0))
         + F.least(F.coalesce(F.col(r2), F.lit(0.0)) * 30, F.lit(30.0)))
    return fx.round_half_even(s, 0)


def confidence_rating(score: str) -> Column:
    """>= 80 high, >= 60 medium, else low."""
    return fx.bin_thresholds(score, [80, 60], ["high", "medium", "low"])


def growth_index(series: DataFrame, keys, order: str = "month", value: str = "median") -> DataFrame:
    """``(v - first) / first * 100`` per group (series tables are aggregated)."""
    w = Window.partitionBy(*_ks(keys)).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    first = F.first(F.col(value), ignorenulls=True).over(w)
    return series.withColumn("index_pct", F.try_divide(F.col(value) - first, first) * 100)


def fill_gaps(series: DataFrame, keys, month: str = "month", value: str = "median") -> DataFrame:
    """Complete the monthly grid between each group's first and last month,
    then forward-fill and back-fill the value.  ``filled`` marks added months."""
    ks = _ks(keys)
    span = series.groupBy(*ks).agg(F.min(month).alias("_a"), F.max(month).alias("_b"))
    grid = span.select(*ks, F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 MONTH"))).alias(month))
    j = grid.join(series.select(*ks, month, value), [*ks, month], "left")
    w_prev = Window.partitionBy(*ks).orderBy(month).rowsBetween(Window.unboundedPreceding, 0)
    w_next = Window.partitionBy(*ks).orderBy(month).rowsBetween(0, Window.unboundedFollowing)
    ff = F.last(F.col(value), ignorenulls=True).over(w_prev)
    bf = F.first(F.col(value), ignorenulls=True).over(w_next)
    return j.select(*ks, month, F.col(value).isNull().alias("filled"),
                    F.coalesce(ff, bf).alias(value))


def poly_forecast(series: DataFrame, keys, t: str, y: str, horizon: int = 6,
                  min_points: int = 4, history: bool = False) -> DataFrame:
    """Least-squares quadratic in the centred index ``t`` per group (degree
    min(2, n-1), so two points give a line and one a constant); forecast ``horizon`` steps; bands +-1.5 sigma (population std of
    residuals).  Closed-form from power sums, no iteration.  With ``history``: the
    fitted past instead, with bands of +-1 sigma."""
    ks = _ks(keys)
    c = series.withColumn("_tm", F.avg(t).over(Window.partitionBy(*ks)))
    c = c.withColumn("_u", F.col(t) - F.col("_tm"))
    u, yy = F.col("_u"), F.col(y)
    s = c.groupBy(*ks).agg(
        F.count(yy).cast("double").alias("n"), F.sum(u * u).alias("S2"), F.sum(u * u * u).alias("S3"),
        F.sum(u * u * u * u).alias("S4"), F.sum(yy).alias("T0"), F.sum(u * yy).alias("T1"),
        F.sum(u * u * yy).alias("T2"), F.first("_tm").alias("tm"), F.max(t).alias("t_last"))
    s = s.where(F.col("n") >= min_points)
    n, S2, S3, S4, T0, T1, T2 = [F.col(k) for k in ("n", "S2", "S3", "S4", "T0", "T1", "T2")]
    det = n * (S2 * S4 - S3 * S3) - S2 * S2 * S2
    # centred index => S1 = 0; solve the 3x3 normal equations in closed form
    b2 = F.when(n > 2, F.try_divide(n * (S2 * T2 - S3 * T1) - S2 * S2 * T0, det)).otherwise(0.0)
    b1 = F.when(n > 1, F.try_divide(T1 - b2 * S3, S2)).otherwise(0.0)
    b0 = (T0 - b2 * S2) / n
    coef = s.select(*ks, "tm", "t_last", "n", b0.alias("b0"), b1.alias("b1"), b2.alias("b2"))
    fit = c.join(coef, ks, "inner")  # a row per kept month
    pred = F.col("b0") + F.col("b1") * F.col("_u") + F.col("b2") * F.col("_u") * F.col("_u")
    sigma = fit.groupBy(*ks).agg(F.sqrt(F.avg((F.col(y) - pred) ** 2)).alias("sigma"))
    if history:
        past = fit.withColumn("fitted", pred).join(sigma, ks, "inner")
        return past.select(*ks, t, F.col(y).alias("actual"), "fitted", (F.col("fitted") - F.col("sigma")).alias("lower"),
                           (F.col("fitted") + F.col("sigma")).alias("upper"))
    fc = coef.join(sigma, ks, "inner").select(
        *ks, "b0", "b1", "b2", "sigma", "t_last", "tm",
        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    uf = F.col("t_last") + F.col("step") - F.col("tm")
    yhat = F.col("b0") + F.col("b1") * uf + F.col("b2") * uf * uf
    return fc.select(*ks, F.col("step").cast("bigint").alias("step"), yhat.alias("forecast"),
                     (yhat - 1.5 * F.col("sigma")).alias("lower"), (yhat + 1.5 * F.col("sigma")).alias("upper"))


def ols_by_group(df: DataFrame, keys, y: str, x: str) -> DataFrame:
    """Slope, intercept, guarded R^2 and n per group (all NULL-skipping)."""
    ks = _ks(keys)
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xs, ys = F.when(both, F.col(x)).cast("double"), F.when(both, F.col(y)).cast("double")
    g = df.groupBy(*ks) if ks else df
    return g.agg(F.regr_slope(ys, xs).alias("slope"), F.regr_intercept(ys, xs).alias("intercept"),
                 F.when(F.var_pop(ys) == 0, F.lit(0.0)).otherwise(F.regr_r2(ys, xs)).alias("r2"),
                 F.regr_count(ys, xs).cast("bigint").alias("n"))


def factor_ranking(df: DataFrame, target: str, factors: Sequence[str], min_rows: int = 20) -> DataFrame:
    """R2 + B8: r of target with each factor (pairwise complete, >= min_rows),
    r rounded to 2 (half-even), strength band and direction, one pass over a long frame."""
    long = df.select(F.col(target).cast("double").alias("_y"),
                     *[F.col(f).cast("double").alias(f) for f in factors]) \
        .unpivot("_y", list(factors), "factor", "_x")
    both = F.col("_x").isNotNull() & F.col("_y").isNotNull()
    r = long.groupBy("factor").agg(safe_corr("_x", "_y").alias("r"), F.count_if(both).cast("bigint").alias("n"))
    r = r.where(F.col("n") >= min_rows)
    a = F.abs(F.col("r"))
    strength = F.when(a >= 0.5, "strong").when(a >= 0.35, "moderate").when(a >= 0.15, "weak").otherwise("none")
    return r.select("factor", "n", fx.round_half_even("r", 2).alias("r"),
                    F.when(F.col("r").isNull(), None).otherwise(strength).alias("strength"),
                    F.when(F.col("r") > 0, "positive").when(F.col("r") < 0, "negative")
                    .otherwise("none").alias("direction"),
                    a.alias("abs_r"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """List-wise complete correlation matrix in long form (var_a, var_b, r).

    Columns are shifted by their means (a one-row aggregate attached as a scalar), which keeps the sums small; one
    aggregate of k(k+1)/2 plain sums of products gives all cells.  A constant column has NULL cells."""
    d = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    d = attach(d, d.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols]))
    d = d.select(*[(F.col(c) - F.col(f"_m_{c}")).alias(c) for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    sums = d.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"s__{a}__{b}") for a, b in pairs])
    cell = lambda a, b: F.col(f"s__{a}__{b}" if (a, b) in pairs else f"s__{b}__{a}")
    cells = [F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"),
                      F.try_divide(cell(a, b), F.sqrt(cell(a, a)) * F.sqrt(cell(b, b))).alias("r")) for a in cols for b in cols]
    return sums.select(F.inline(F.array(*cells)))
