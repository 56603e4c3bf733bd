"""Region scoring and geography.

Indicators arrive long ``(region, indicator, value)``; scores are weighted sums
of anchor-scaled values built as column expressions over the pivoted (one row
per region) table, so the weight and anchor tables are code-defined
parameters, not joins.  Region-level tables are small aggregates; the windows
over them (max over all regions, ranks) run on those aggregates only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotmarket.functions import core as fx
from lotmarket.operators.common import attach


def pivot_indicators(long: DataFrame, region: str, indicators: Sequence[str]) -> DataFrame:
    """Long -> wide with an explicit indicator list (absent indicators are NULL)."""
    return long.groupBy(region).agg(*[F.max(F.when(F.col("indicator") == i, F.col("value"))).alias(i)
                                      for i in indicators])


def livability(wide: DataFrame, region: str, pillars, available: Sequence[str]) -> DataFrame:
    """``sum(pillar_weight * sum(weight * scale(value, best, worst)))`` rounded
    half-even to 1 decimal.

    ``pillars`` = [(pillar_weight, [(indicator, weight, best, worst), ...]), ...];
    an indicator that is NULL or not in ``available`` scores 0.5.
    """
    cols = set(available)
    fixed = [(pw, [(i if i in cols else None, w, b, wo) for i, w, b, wo in m]) for pw, m in pillars]
    total = F.lit(0.0)
    for pw, members in fixed:
        inner = F.lit(0.0)
        for ind, w, best, worst in members:
            term = fx.scale_anchors(ind, best, worst) if ind else F.lit(0.5)
            inner = inner + F.lit(float(w)) * term
        total = total + F.lit(float(pw)) * inner
    return wide.select(region, fx.round_half_even(total, 1).alias("livability"))


def pillar_scores(wide: DataFrame, region: str, dims, available: Sequence[str]) -> DataFrame:
    """Per region and dimension, anchor-scaled score 0..100 rounded to 1; missing -> 50."""
    cols = set(available)
    parts = []
    for name, ind, best, worst in dims:
        v = fx.scale_anchors(ind, best, worst, missing=50.0, top=100.0) if ind in cols else F.lit(50.0)
        parts.append(F.struct(F.lit(name).alias("dimension"), fx.round_half_even(v, 1).alias("score")))
    return wide.select(region, F.inline(F.array(*parts)))


def invest_score(liv: DataFrame, med: DataFrame, region: str, median: str = "median") -> DataFrame:
    """``.6 * livability + .4 * (1 - median / max median) * 100`` rounded to 1;
    a region without sales uses the max median (affordability 0)."""
    j = liv.join(med, region, "left")
    mx = F.max(median).over(Window.partitionBy())
    m = F.coalesce(F.col(median), mx)
    return j.select(region, "livability", F.col(median),
                    fx.round_half_even(F.col("livability") * 0.6 + (1 - m / mx) * 100 * 0.4, 1).alias("invest_score"))


def recommend_many(prefs: DataFrame, wide: DataFrame, region: str, med: DataFrame, attrs, budget: str,
                   median: str = "median") -> DataFrame:
    """X5 for a table of preferences: each row has a weight per attribute (a column of its name) and a budget, and gets
    its best region and score (ties: the first by name).

    The region table, a row per region, is one array-valued scalar on every preference row; nothing is joined."""
    j = wide.join(med, region, "left")
    fits = []
    for name, ind, best, worst, default in attrs:
        v = F.coalesce(F.col(ind), F.lit(float(default))) if ind in wide.columns else F.lit(float(default))
        fits.append(F.least(F.greatest((v - F.lit(float(worst))) / F.lit(float(best - worst)) * 100, F.lit(0.0)), F.lit(100.0)).alias(name))
    table = j.select(F.col(region).alias("region"), (F.col(median) / 1e3).alias("med_k"), *fits)
    rows = attach(prefs, table.agg(F.collect_list(F.struct(*table.columns)).alias("_regions")))
    weights = sum((F.col(n) for n, *_ in attrs), F.lit(0.0))

    def score(r):
        num = sum((r[n] * F.col(n) for n, *_ in attrs), F.lit(0.0))
        over = F.greatest(F.lit(0.1), 1 - (r["med_k"] - F.col(budget)) / F.col(budget))
        return fx.round_half_even(num / weights * F.when(r["med_k"] <= F.col(budget), F.lit(1.0)).otherwise(over), 1)

    best = F.array_min(F.transform("_regions", lambda r: F.struct((-score(r)).alias("loss"), r["region"].alias("region"))))
    return rows.withColumn("_best", best).withColumn("region", F.col("_best.region")).withColumn("score", -F.col("_best.loss")).drop("_best", "_regions")


def recommend(wide: DataFrame, region: str, med: DataFrame, yoy: DataFrame | None, attrs, weights: dict,
              budget: float, growth_weight: float = 8.0, median: str = "median") -> DataFrame:
    """Weighted attribute match 0..100, optional growth term (YoY scaled
    -5..15), budget penalty ``max(.1, 1 - over/budget)``, rank and label.

    ``attrs`` = [(name, indicator, best, worst, default_value)].
    """
    j = wide.join(med, region, "left")
    if yoy is not None:
        j = j.join(yoy.select(region, "yoy_pct"), region, "left")
    num = F.lit(0.0)
    wsum = 0.0
    for name, ind, best, worst, default in attrs:
        v = F.coalesce(F.col(ind), F.lit(float(default))) if ind in wide.columns else F.lit(float(default))
        s = F.least(F.greatest((v - F.lit(float(worst))) / F.lit(float(best - worst)) * 100, F.lit(0.0)), F.lit(100.0))
        num = num + s * F.lit(float(weights[name]))
        wsum += weights[name]
    if yoy is not None:
        g = F.least(F.greatest((F.coalesce(F.col("yoy_pct"), F.lit(0.0)) + 5) / 20 * 100, F.lit(0.0)), F.lit(100.0))
        num = num + g * F.lit(growth_weight)
        wsum += growth_weight
    med_k = F.col(median) / 1e3
    penalty = F.when(med_k <= budget, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.1), 1 - (med_k - budget) / F.lit(float(budget))))
    score = fx.round_half_even(num / F.lit(wsum) * penalty, 1)
    out = j.select(region, F.col(median), score.alias("score"))
    out = out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), F.asc(region))))
    return out.withColumn("label", fx.bin_thresholds("score", [80, 60], ["strong", "medium", "weak"]))


def indicator_standing(long: DataFrame, region: str, directions: DataFrame) -> DataFrame:
    """X6 + B10: for each (indicator, region): min-max position among regions,
    flipped when low is good, banded at .25/.5/.75; all-equal -> neutral.
    ``directions`` = (indicator, high_is_good); indicators absent from the data
    appear with NULL value and no band."""
    j = directions.join(long, "indicator", "left")
    w = Window.partitionBy("indicator")
    mn, mx = F.min("value").over(w), F.max("value").over(w)
    norm = F.try_divide(F.col("value") - mn, mx - mn)
    norm = F.when(F.col("high_is_good"), norm).otherwise(1 - norm)
    band = (F.when(F.col("value").isNull(), F.lit(None))
            .when(mx == mn, F.lit("neutral"))
            .when(norm >= 0.75, "best").when(norm >= 0.5, "good").when(norm >= 0.25, "fair").otherwise("worst"))
    return j.select("indicator", region, "value", "high_is_good",
                    F.when(mx != mn, norm).alias("position"), band.alias("band"))


def amenity_score(parks, hospitals, supermarkets, divisor: float = 1.0) -> F.Column:
    """``.04*parks + .3*hospitals + .15*supermarkets`` (/ divisor), clamped 1..10, 4 decimals."""
    raw = (F.lit(0.04) * parks + F.lit(0.3) * hospitals + F.lit(0.15) * supermarkets) / F.lit(divisor)
    return fx.round_half_even(F.least(F.greatest(raw, F.lit(1.0)), F.lit(10.0)), 4)


def loan_costs(df: DataFrame, price: str, rate_pct: str, years: str, down_pct: str) -> DataFrame:
    """Down payment, monthly annuity (zero-rate branch), total interest and the
    income needed at 35 % of income, per request row."""
    down = F.col(price) * F.col(down_pct) / 100
    loan = F.col(price) - down
    r = F.col(rate_pct) / 100 / 12
    n = F.col(years) * 12
    growth = F.pow(1 + r, n)
    monthly = F.when(r > 0, loan * (r * growth) / (growth - 1)).otherwise(loan / n)
    return df.select("*", down.alias("down_payment"), loan.alias("loan_amount"), monthly.alias("monthly_payment"),
                     (monthly * n - loan).alias("total_interest"), (monthly * 12 / 0.35).alias("min_income"))


def coords_with_fallback(areas: DataFrame, area: str, region: str, known: DataFrame, centres: DataFrame,
                         city_centre: tuple[float, float], step: float = 0.0008) -> DataFrame:
    """G1: known coordinates, else the region centre offset by an Adler-32 hash of
    the area name, else the city centre offset the same way.  Lookup tables are
    code-defined and broadcast."""
    h = fx.adler32(F.col(area))
    j = areas.join(F.broadcast(known.select(F.col("name").alias("_kn"), F.col("lat").alias("_klat"),
                                            F.col("lon").alias("_klon"))), F.col(area) == F.col("_kn"), "left")
    j = j.join(F.broadcast(centres.select(F.col("name").alias("_cn"), F.col("lat").alias("_clat"),
                                          F.col("lon").alias("_clon"))), F.col(region) == F.col("_cn"), "left")
    base_lat = F.coalesce(F.col("_clat"), F.lit(city_centre[0]))
    base_lon = F.coalesce(F.col("_clon"), F.lit(city_centre[1]))
    off_lat = ((h % 100) - 50) * step
    off_lon = ((F.floor(h / 100) % 100) - 50) * step
    return j.select(*areas.columns,
                    F.coalesce(F.col("_klat"), base_lat + off_lat).alias("lat"),
                    F.coalesce(F.col("_klon"), base_lon + off_lon).alias("lon"),
                    F.when(F.col("_klat").isNotNull(), "known").when(F.col("_clat").isNotNull(), "region")
                    .otherwise("city").alias("source"))
