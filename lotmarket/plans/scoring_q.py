"""Scoring and geography queries over region indicators derived
from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotmarket.operators import market as mk
from lotmarket.operators import scoring as sc
from lotmarket.plans.binding import GEO_SQL, REGION_INDICATORS_SQL, geo, region_indicators_long, table, with_sales
from lotmarket.plans.catalog import register
from lotmarket.plans.common import finish
from lotmarket.plans.market_q import S_CTE, floored
from lotmarket.plans.scalar_q import _adler_sql

AVAILABLE = ["population", "boro_income", "poverty_pct", "bachelor_pct", "parks_count", "walk_score_raw",
             "crime_pct", "school_pct"]

# Pillar weights of the livability score (15 x 6 + 10; the
# economy pillar's weights sum to .8), with (best, worst) anchors.  Anchors of
# indicators the stand-in tables provide are set to the stand-in's units;
# indicators they lack score 0.5 as missing values do.
PILLARS = [
    (15, [("crime_pct", 1.0, 10, 30)]),
    (15, [("life_expectancy", 0.5, 90, 60), ("obesity_pct", 0.25, 0, 50), ("uninsured_pct", 0.25, 0, 30)]),
    (15, [("boro_income", 0.5, 5000, 4000), ("poverty_pct", 0.3, 5, 15)]),
    (15, [("bachelor_pct", 0.5, 30, 10), ("school_pct", 0.5, 60, 40)]),
    (15, [("pm25", 0.5, 0, 25), ("parks_count", 0.5, 1100, 0)]),
    (15, [("subway_count", 0.5, 300, 0), ("walk_score_raw", 0.5, 6000, 3000)]),
    (10, [("starbucks_count", 0.4, 210, 0), ("supermarkets_count", 0.4, 600, 0), ("hospitals_count", 0.2, 350, 0)]),
]

IW_SQL = GEO_SQL + "," + REGION_INDICATORS_SQL + ",\niw AS (SELECT region, " + ", ".join(
    f"max(value) FILTER (WHERE indicator = '{c}') AS {c}" for c in AVAILABLE) + " FROM region_indicators GROUP BY region)"


def _scale_sql(ind, best, worst, missing="0.5", top="1.0"):
    if ind not in AVAILABLE:
        return missing
    return (f"(CASE WHEN {ind} IS NULL THEN {missing} ELSE least(greatest(({ind} - ({worst})) / (({best}) - ({worst})), 0.0), 1.0) * {top} END)")


LIV_SQL = "round_even(" + " + ".join(
    f"{pw} * (" + " + ".join(f"{w} * {_scale_sql(i, b, wo)}" for i, w, b, wo in m) + ")" for pw, m in PILLARS) + ", 1)"


def wide(spark, d):
    return sc.pivot_indicators(region_indicators_long(spark, d), "region", AVAILABLE)


def liv(spark, d):
    return sc.livability(wide(spark, d), "region", PILLARS, AVAILABLE)


@register("scale_anchors", with_sales(
    "SELECT region, " + ", ".join(f"round({_scale_sql(i, b, wo)}, 4) AS {i}" for i, _, b, wo in
                                  [m for _, ms in PILLARS for m in ms] if i in AVAILABLE) + " FROM iw", IW_SQL))
def scale_anchors(spark, d):
    from lotmarket.functions.core import scale_anchors as scale
    w = wide(spark, d)
    return finish(w.select("region", *[scale(i, b, wo).alias(i) for _, ms in PILLARS for i, _, b, wo in ms
                                       if i in AVAILABLE]))


@register("livability", with_sales(f"SELECT region, {LIV_SQL} AS livability FROM iw", IW_SQL))
def livability(spark, d):
    return finish(liv(spark, d))


MED_CTE = IW_SQL + ",\n" + S_CTE + ",\nmed AS (SELECT borough_name AS region, median(sale_price) AS median FROM s GROUP BY 1)"
INVEST_SQL = f"""inv AS (SELECT l.region, l.livability, m.median,
  round_even(l.livability * 0.6 + (1 - coalesce(m.median, max(m.median) OVER ()) / max(m.median) OVER ()) * 100 * 0.4, 1) AS invest_score
  FROM (SELECT region, {LIV_SQL} AS livability FROM iw) l LEFT JOIN med m USING (region))"""


def medians(spark, d):
    return mk.median_by(floored(spark, d), "borough_name", "sale_price").withColumnRenamed("borough_name", "region")


@register("invest_score", with_sales("SELECT region, livability, round(median, 4) AS median, invest_score FROM inv",
                                     MED_CTE + ",\n" + INVEST_SQL))
def invest_score(spark, d):
    return finish(sc.invest_score(liv(spark, d), medians(spark, d), "region"))


# Radar dimensions: (name, indicator, best, worst); reference anchors for the
# safety/education pairs, stand-in anchors where the stand-in provides the value.
DIMS = [("safety", "crime_pct", 10, 30), ("health", "life_expectancy", 90, 60), ("education", "bachelor_pct", 30, 10),
        ("environment", "parks_count", 1100, 0), ("infrastructure", "walk_score_raw", 6000, 3000)]


@register("pillar_scores", with_sales(" UNION ALL ".join(
    f"SELECT region, '{n}' AS dimension, round_even({_scale_sql(i, b, wo, '50.0', '100.0')}, 1) AS score FROM iw"
    for n, i, b, wo in DIMS), IW_SQL))
def pillar_scores(spark, d):
    return finish(sc.pillar_scores(wide(spark, d), "region", DIMS, AVAILABLE))


# Recommender attributes: (name, indicator, best, worst, default) and the two
# weight presets of the reference (live: 9,8,7,7,6; invest: 6,5,8,5,7 + growth 8).
ATTRS = [("safety", "crime_pct", 10, 30, 20), ("schools", "school_pct", 60, 40, 50),
         ("transit", "walk_score_raw", 6000, 3000, 4500), ("green", "parks_count", 1100, 0, 400),
         ("walk", "bachelor_pct", 30, 10, 20)]
LIVE_W = {"safety": 9, "schools": 8, "transit": 7, "green": 7, "walk": 6}
INVEST_W = {"safety": 6, "schools": 5, "transit": 8, "green": 5, "walk": 7}
BUDGET_K = 40.0
GROWTH_YEARS = (1999, 2000)


def _attr_sql(w):
    parts = [f"least(greatest((coalesce({i}, {dflt}) - ({wo})) / (({b}) - ({wo})) * 100, 0.0), 100.0) * {w[n]}"
             for n, i, b, wo, dflt in ATTRS]
    return " + ".join(parts)


def _rec_sql(mode, w, growth):
    wsum = sum(w.values()) + (8 if growth else 0)
    g = " + least(greatest((coalesce(yoy_pct, 0.0) + 5) / 20 * 100, 0.0), 100.0) * 8" if growth else ""
    pen = f"CASE WHEN median / 1e3 <= {BUDGET_K} THEN 1.0 ELSE greatest(0.1, 1 - (median / 1e3 - {BUDGET_K}) / {BUDGET_K}) END"
    return (f"SELECT '{mode}' AS mode, region, round(median, 4) AS median, score, "
            f"row_number() OVER (ORDER BY score DESC, region) AS rank, "
            f"CASE WHEN score >= 80 THEN 'strong' WHEN score >= 60 THEN 'medium' ELSE 'weak' END AS label FROM ("
            f"SELECT region, median, round_even(({_attr_sql(w)}{g}) / {wsum} * {pen}, 1) AS score "
            f"FROM iw LEFT JOIN med USING (region) LEFT JOIN yoy USING (region))")


YOY_SQL = f"""yoy AS (SELECT borough_name AS region,
  coalesce((median(sale_price) FILTER (WHERE sale_year = {GROWTH_YEARS[1]}) - median(sale_price) FILTER (WHERE sale_year = {GROWTH_YEARS[0]}))
           / median(sale_price) FILTER (WHERE sale_year = {GROWTH_YEARS[0]}) * 100, 0.0) AS yoy_pct
  FROM s WHERE sale_year IN {GROWTH_YEARS!r} GROUP BY 1)"""


@register("recommend_regions", with_sales(_rec_sql("live", LIVE_W, False) + " UNION ALL "
                                          + _rec_sql("invest", INVEST_W, True), MED_CTE + ",\n" + YOY_SQL))
def recommend_regions(spark, d):
    w = wide(spark, d)
    med = medians(spark, d)
    yoy = mk.yoy_fixed_years(floored(spark, d), "borough_name", "sale_year", "sale_price", *GROWTH_YEARS) \
        .withColumnRenamed("borough_name", "region")
    live = sc.recommend(w, "region", med, None, ATTRS, LIVE_W, BUDGET_K).withColumn("mode", F.lit("live"))
    inv = sc.recommend(w, "region", med, yoy, ATTRS, INVEST_W, BUDGET_K).withColumn("mode", F.lit("invest"))
    return finish(live.unionByName(inv))


# Preferences of the stand-in users: weights 1 to 10 and a budget from the digits of the customer key.
PREFS = {n: f"1 + (c_custkey div {3 ** i}) % 10" for i, (n, *_) in enumerate(ATTRS)}
BUDGET_SQL = "20.0 + c_custkey % 40"


def _many_sql() -> str:
    score = " + ".join(f"least(greatest((coalesce({i}, {dflt}) - ({wo})) / (({b}) - ({wo})) * 100, 0.0), 100.0) * ({PREFS[n].replace(' div ', ' // ')})"
                       for n, i, b, wo, dflt in ATTRS)
    wsum = " + ".join(f"({x.replace(' div ', ' // ')})" for x in PREFS.values())
    pen = "CASE WHEN median / 1e3 <= budget THEN 1.0 ELSE greatest(0.1, 1 - (median / 1e3 - budget) / budget) END"
    return f"""SELECT c_custkey, region, score FROM (
  SELECT c_custkey, region, score, row_number() OVER (PARTITION BY c_custkey ORDER BY score DESC, region) AS rk FROM (
    SELECT c_custkey, region, round_even(({score}) / ({wsum}) * {pen}, 1) AS score
    FROM (SELECT c_custkey, {BUDGET_SQL} AS budget FROM customer) CROSS JOIN iw LEFT JOIN med USING (region))) WHERE rk = 1"""


@register("recommend_users", with_sales(_many_sql(), MED_CTE))
def recommend_users(spark, d):
    """X5 for many users: a preference row per customer, the best region for each."""
    c = table(spark, d, "customer").select("c_custkey")
    prefs = c.select("c_custkey", *[F.expr(f"CAST({x} AS DOUBLE)").alias(n) for n, x in PREFS.items()], F.expr(f"CAST({BUDGET_SQL} AS DOUBLE)").alias("budget"))
    out = sc.recommend_many(prefs, wide(spark, d), "region", medians(spark, d), ATTRS, "budget")
    return finish(out.select("c_custkey", "region", "score"))


# Direction flags (True = high is good); one indicator the data lacks shows as missing.
DIRECTIONS = [("crime_pct", False), ("violent_crime_pct", False), ("boro_income", True), ("poverty_pct", False),
              ("bachelor_pct", True), ("school_pct", True), ("parks_count", True), ("walk_score_raw", True),
              ("population", True)]


@register("indicator_standing", with_sales("""
SELECT indicator, region, round(value, 4) AS value, high_is_good,
       round(CASE WHEN mx <> mn THEN CASE WHEN high_is_good THEN (value - mn) / (mx - mn) ELSE 1 - (value - mn) / (mx - mn) END END, 4) AS position,
       CASE WHEN value IS NULL THEN NULL WHEN mx = mn THEN 'neutral'
            WHEN (CASE WHEN high_is_good THEN (value - mn) / (mx - mn) ELSE 1 - (value - mn) / (mx - mn) END) >= 0.75 THEN 'best'
            WHEN (CASE WHEN high_is_good THEN (value - mn) / (mx - mn) ELSE 1 - (value - mn) / (mx - mn) END) >= 0.5 THEN 'good'
            WHEN (CASE WHEN high_is_good THEN (value - mn) / (mx - mn) ELSE 1 - (value - mn) / (mx - mn) END) >= 0.25 THEN 'fair'
            ELSE 'worst' END AS band
FROM (SELECT d.indicator, d.high_is_good, r.region, r.value,
             min(r.value) OVER (PARTITION BY d.indicator) AS mn, max(r.value) OVER (PARTITION BY d.indicator) AS mx
      FROM (VALUES """ + ", ".join(f"('{i}', {str(h).lower()})" for i, h in DIRECTIONS) + """) d(indicator, high_is_good)
      LEFT JOIN region_indicators r USING (indicator))""", GEO_SQL + "," + REGION_INDICATORS_SQL))
def indicator_standing(spark, d):
    dirs = spark.createDataFrame(DIRECTIONS, "indicator string, high_is_good boolean")
    return finish(sc.indicator_standing(region_indicators_long(spark, d), "region", dirs))


AMEN_SQL = """am AS (SELECT g.borough_name AS region,
  count(*) FILTER (WHERE c.c_mktsegment = 'BUILDING') AS parks,
  count(*) FILTER (WHERE c.c_mktsegment = 'AUTOMOBILE') AS hospitals,
  count(*) FILTER (WHERE c.c_mktsegment = 'MACHINERY') AS supermarkets
  FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey GROUP BY 1)"""


@register("amenity_counts_score", with_sales("""
SELECT region, parks, hospitals, supermarkets,
       CAST(round_even(least(greatest(0.04 * parks + 0.3 * hospitals + 0.15 * supermarkets, 1.0), 10.0), 4) AS DOUBLE) AS amenity_score,
       CASE WHEN region = 'AMERICA' THEN 10.0
            ELSE round_even(least(greatest((0.04 * parks + 0.3 * hospitals + 0.15 * supermarkets) / 17.5, 1.0), 10.0), 4) END AS amenity_score_backup
FROM am""", GEO_SQL + ",\n" + AMEN_SQL))
def amenity_counts_score(spark, d):
    c = table(spark, d, "customer").join(F.broadcast(geo(spark, d)), F.col("c_nationkey") == F.col("n_nationkey"))
    am = c.groupBy(F.col("borough_name").alias("region")).agg(
        F.count_if(F.col("c_mktsegment") == "BUILDING").cast("bigint").alias("parks"),
        F.count_if(F.col("c_mktsegment") == "AUTOMOBILE").cast("bigint").alias("hospitals"),
        F.count_if(F.col("c_mktsegment") == "MACHINERY").cast("bigint").alias("supermarkets"))
    p, h, s = F.col("parks"), F.col("hospitals"), F.col("supermarkets")
    out = am.select("region", "parks", "hospitals", "supermarkets", sc.amenity_score(p, h, s).alias("amenity_score"),
                    F.when(F.col("region") == "AMERICA", F.lit(10.0))
                    .otherwise(sc.amenity_score(p, h, s, 17.5)).alias("amenity_score_backup"))
    return finish(out)


@register("region_table", with_sales("""
SELECT inv.region, inv.livability, inv.invest_score, round(inv.median, 4) AS median_price,
       round(a.mean_unit_price, 4) AS mean_unit_price, a.n, round(iw.boro_income, 4) AS boro_income
FROM inv JOIN (SELECT borough_name AS region, avg(unit_price) AS mean_unit_price, count(*) AS n FROM s GROUP BY 1) a
  USING (region) JOIN iw USING (region)""", MED_CTE + ",\n" + INVEST_SQL))
def region_table(spark, d):
    s = floored(spark, d)
    a = s.groupBy(F.col("borough_name").alias("region")).agg(F.avg("unit_price").alias("mean_unit_price"),
                                                           F.count("*").cast("bigint").alias("n"))
    inv = sc.invest_score(liv(spark, d), medians(spark, d), "region").withColumnRenamed("median", "median_price")
    out = inv.join(a, "region").join(wide(spark, d).select("region", "boro_income"), "region")
    return finish(out)


@register("loan_costs", """
SELECT o_orderkey, price, rate, years, down_pct, round(price * down_pct / 100, 4) AS down_payment,
       round(loan, 4) AS loan_amount, round(m, 4) AS monthly_payment, round(m * years * 12 - loan, 4) AS total_interest,
       round(m * 12 / 0.35, 4) AS min_income
FROM (SELECT *, CASE WHEN rate / 100 / 12 > 0
                     THEN loan * (rate / 100 / 12 * pow(1 + rate / 100 / 12, years * 12)) / (pow(1 + rate / 100 / 12, years * 12) - 1)
                     ELSE loan / (years * 12) END AS m
      FROM (SELECT *, price - price * down_pct / 100 AS loan FROM (
        SELECT o_orderkey, o_totalprice AS price,
               CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE 3.0 + (o_totalprice % 600) / 100.0 END AS rate,
               CAST(CASE WHEN o_orderstatus = 'F' THEN 15 ELSE 30 END AS BIGINT) AS years,
               CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 10 ELSE 20 END AS DOUBLE) AS down_pct FROM orders)))""")
def loan_costs(spark, d):
    o = table(spark, d, "orders")
    req = o.select("o_orderkey", F.col("o_totalprice").alias("price"),
                   F.when(F.col("o_orderstatus") == "P", F.lit(0.0))
                   .otherwise(3.0 + (F.col("o_totalprice") % 600) / 100.0).alias("rate"),
                   F.when(F.col("o_orderstatus") == "F", 15).otherwise(30).cast("bigint").alias("years"),
                   F.when(F.col("o_orderpriority") == "1-URGENT", 10.0).otherwise(20.0).alias("down_pct"))
    return finish(sc.loan_costs(req, "price", "rate", "years", "down_pct"))


# Region centres (the reference's five borough centroids, in
# region-key order; the fifth region is left without a centre), a few known
# area coordinates, and the city centre.
CENTRES = [("AFRICA", 40.7831, -73.9712), ("AMERICA", 40.6782, -73.9442), ("ASIA", 40.7282, -73.7949),
           ("EUROPE", 40.8448, -73.8648)]
KNOWN = [("Customer#000000003", 40.5515, -74.1513), ("Customer#000000011", 40.5980, -74.1100)]
CITY = (40.7128, -74.0060)


@register("geo_fallback", f"""
WITH {GEO_SQL.strip()},
n AS (SELECT DISTINCT c_name AS neighborhood, borough_name FROM customer JOIN geo ON c_nationkey = n_nationkey),
a AS (SELECT *, {_adler_sql('neighborhood')} AS h FROM n)
SELECT a.neighborhood, a.borough_name,
       CAST(round(coalesce(k.lat, coalesce(c.lat, {CITY[0]}) + ((h % 100) - 50) * 0.0008), 4) AS DOUBLE) AS lat,
       CAST(round(coalesce(k.lon, coalesce(c.lon, {CITY[1]}) + (((h // 100) % 100) - 50) * 0.0008), 4) AS DOUBLE) AS lon,
       CASE WHEN k.lat IS NOT NULL THEN 'known' WHEN c.lat IS NOT NULL THEN 'region' ELSE 'city' END AS source
FROM a LEFT JOIN (VALUES {", ".join(f"('{n}', {la}, {lo})" for n, la, lo in KNOWN)}) k(name, lat, lon) ON a.neighborhood = k.name
LEFT JOIN (VALUES {", ".join(f"('{n}', {la}, {lo})" for n, la, lo in CENTRES)}) c(name, lat, lon) ON a.borough_name = c.name""")
def geo_fallback(spark, d):
    """G1: places are the customers, by name; two have known coordinates, the others lie around their region's centre."""
    g = geo(spark, d).select("n_nationkey", "borough_name")
    c = table(spark, d, "customer").select("c_nationkey", F.col("c_name").alias("neighborhood"))
    areas = c.join(F.broadcast(g), F.col("c_nationkey") == F.col("n_nationkey")).select("neighborhood", "borough_name").distinct()
    known = spark.createDataFrame(KNOWN, "name string, lat double, lon double")
    centres = spark.createDataFrame(CENTRES, "name string, lat double, lon double")
    return finish(sc.coords_with_fallback(areas, "neighborhood", "borough_name", known, centres, CITY))


@register("rank_regions", with_sales(f"""
SELECT region, livability, row_number() OVER (ORDER BY livability DESC, region) AS rank
FROM (SELECT region, {LIV_SQL} AS livability FROM iw)""", IW_SQL))
def rank_regions(spark, d):
    from pyspark.sql import Window
    lv = liv(spark, d)
    # ranks over the region table (one row per region)
    return finish(lv.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("livability"), "region"))))


VS_PRICE = ["parks_count", "boro_income", "crime_pct"]


@register("indicator_vs_price", with_sales("""
SELECT indicator, round(regr_slope(med_k, value), 4) AS slope, round(regr_intercept(med_k, value), 4) AS intercept,
       CAST(regr_count(med_k, value) AS BIGINT) AS n
FROM region_indicators JOIN (SELECT region, median / 1e3 AS med_k FROM med) USING (region)
WHERE indicator IN """ + repr(tuple(VS_PRICE)) + " GROUP BY 1", MED_CTE))
def indicator_vs_price(spark, d):
    from lotmarket.operators.trend import ols_by_group
    long = region_indicators_long(spark, d).where(F.col("indicator").isin(*VS_PRICE))
    med = medians(spark, d).withColumn("med_k", F.col("median") / 1e3)
    j = long.join(med, "region")
    out = ols_by_group(j, "indicator", "med_k", "value").drop("r2")
    return finish(out)
