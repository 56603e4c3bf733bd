"""Market-analysis queries over the stand-in sales star."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotmarket.functions import core as fx
from lotmarket.operators import market as mk
from lotmarket.operators.stats import group_quantiles
from lotmarket.plans.binding import HIGH_PRICE, PRICE_FLOOR, sales, table, with_sales
from lotmarket.plans.catalog import register
from lotmarket.plans.common import finish
from lotmarket.sources.files import materialize

# CTE used by most oracles: the price-floored slice with unit price.
S_CTE = """s AS (
  SELECT *, CASE WHEN gross_sqft > 0 THEN sale_price / gross_sqft END AS unit_price
  FROM sales WHERE sale_price > 10000)"""


def floored(spark, d, part: bool = False):
    """Price-floored sales with unit price; the part join only when asked for."""
    s = mk.price_floor(sales(spark, d, part=part), "sale_price", PRICE_FLOOR)
    return s.withColumn("unit_price", fx.guarded_ratio("sale_price", "gross_sqft"))


@register("median_by_region", with_sales(
    "SELECT borough_name, round(median(sale_price), 4) AS median FROM s GROUP BY borough_name", S_CTE))
def median_by_region(spark, d):
    return finish(mk.median_by(floored(spark, d), "borough_name", "sale_price"))


@register("kpi_overview", with_sales("""
SELECT count(*) AS n_sales, round(avg(sale_price), 4) AS mean_price,
       round(CAST(sum(CAST(sale_price AS DECIMAL(18,2))) AS DOUBLE), 4) AS total_value,
       round(avg(CASE WHEN sale_price >= 50000 THEN 1.0 ELSE 0.0 END) * 100, 4) AS pct_high,
       round(median(sale_price), 4) AS median_price, round(median(unit_price), 4) AS median_unit_price,
       (SELECT CAST(arg_max(c, sale_year) AS BIGINT) FROM y) AS latest_year_sales,
       (SELECT max(sale_year) FROM y) AS latest_year
FROM s""", S_CTE + ", y AS (SELECT sale_year, count(*) AS c FROM s GROUP BY sale_year)"))
def kpi_overview(spark, d):
    return finish(mk.kpi_row(floored(spark, d), "sale_price", "unit_price", HIGH_PRICE, "sale_year"))


@register("count_by_region", with_sales("""
SELECT r.r_name AS borough_name, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM region r LEFT JOIN (SELECT borough_name, count(*) AS n FROM s GROUP BY borough_name) c
  ON r.r_name = c.borough_name""", S_CTE))
def count_by_region(spark, d):
    order = table(spark, d, "region").select(F.col("r_name"))
    return finish(mk.count_in_order(floored(spark, d), "borough_name", order, "r_name"))


@register("hotspots", with_sales("""
SELECT borough_name, neighborhood, n, round(median_price, 4) AS median_price,
       round(median_unit_price, 4) AS median_unit_price,
       row_number() OVER (ORDER BY median_price DESC, neighborhood) <= 3 AS top_price,
       row_number() OVER (ORDER BY n DESC, neighborhood) <= 3 AS top_volume
FROM (SELECT borough_name, neighborhood, count(*) AS n, median(sale_price) AS median_price,
             coalesce(median(unit_price), 0) AS median_unit_price
      FROM s GROUP BY borough_name, neighborhood)""", S_CTE))
def hotspots(spark, d):
    s = floored(spark, d)
    keys = ["borough_name", "neighborhood"]
    # both medians in one quantile pass over (measure, area); the price's counts are the areas' row counts
    long = s.select(*keys, F.col("sale_price").cast("double").alias("median_price"), F.col("unit_price").cast("double").alias("median_unit_price")) \
        .unpivot(keys, ["median_price", "median_unit_price"], "measure", "v")
    med = group_quantiles(long, [*keys, "measure"], "v", {"m": 0.5}, with_n="n")
    of = lambda c, x: F.max(F.when(F.col("measure") == c, F.col(x)))
    t = med.groupBy(*keys).agg(of("median_price", "n").alias("n"), of("median_price", "m").alias("median_price"),
                               F.coalesce(of("median_unit_price", "m"), F.lit(0.0)).alias("median_unit_price"))
    t = materialize(t, "areas")  # one row per area, read by both rankings
    t = mk.flag_top(t, keys, [F.desc("median_price"), "neighborhood"], 3, "top_price")
    return finish(mk.flag_top(t, keys, [F.desc("n"), "neighborhood"], 3, "top_volume"))


@register("risk_cv", with_sales("""
SELECT neighborhood, n, round(std, 4) AS std, round(median, 4) AS median, cv_pct,
       CASE WHEN cv_pct > 0 AND cv_pct <= 80 THEN 'low' WHEN cv_pct > 80 AND cv_pct <= 120 THEN 'medium'
            WHEN cv_pct > 120 THEN 'high' END AS risk
FROM (SELECT neighborhood, count(sale_price) AS n, stddev_samp(sale_price) AS std, median(sale_price) AS median,
             round_even(stddev_samp(sale_price) / median(sale_price) * 100, 1) AS cv_pct
      FROM s GROUP BY neighborhood)""", S_CTE))
def risk_cv(spark, d):
    return finish(mk.dispersion(floored(spark, d), "neighborhood", "sale_price"))


@register("segment_units", with_sales("""
SELECT segment, n, round(median, 4) AS median, round(n * 100.0 / sum(n) OVER (), 4) AS share_pct
FROM (SELECT CASE WHEN total_units > -1 AND total_units <= 1 THEN 'own-use'
                  WHEN total_units > 1 AND total_units <= 10 THEN 'small investor'
                  WHEN total_units > 10 THEN 'institution' END AS segment,
             count(*) AS n, median(sale_price) AS median
      FROM s WHERE total_units > -1 GROUP BY 1)""", S_CTE))
def segment_units(spark, d):
    return finish(mk.segment_table(floored(spark, d, part=True), "total_units", "sale_price"))


# Area bins: the stand-in area (quantity 1..50) is binned right-closed over
# (0, 50] in 10 bins of 5 (the reference bins sqft over (100, 4100] by 200).
AREA_LO, AREA_W, AREA_N = 0.0, 5.0, 10


@register("area_bins", with_sales("""
SELECT b AS bin, n, round(median, 4) AS median, CAST(0.0 + (b - 1) * 5.0 AS DOUBLE) AS bin_label
FROM (SELECT CAST(ceil((gross_sqft - 0.0) / 5.0) AS BIGINT) AS b, count(*) AS n, median(sale_price) AS median
      FROM s WHERE gross_sqft > 0 AND gross_sqft <= 50 GROUP BY 1)
WHERE n >= 10""", S_CTE))
def area_bins(spark, d):
    return finish(mk.binned_medians(floored(spark, d), "gross_sqft", "sale_price", AREA_LO, AREA_W, AREA_N))


# Age bands over days between order and ship (the stand-in age), kept in 0..120.
AGE_EDGES = [-1, 15, 35, 65, 120]
AGE_LABELS = ["0-15", "16-35", "36-65", "66-120"]


@register("age_bands", with_sales("""
SELECT band, count(*) AS n, round(median(sale_price), 4) AS median
FROM (SELECT *, CASE WHEN age_days > -1 AND age_days <= 15 THEN '0-15'
                     WHEN age_days > 15 AND age_days <= 35 THEN '16-35'
                     WHEN age_days > 35 AND age_days <= 65 THEN '36-65'
                     WHEN age_days > 65 AND age_days <= 120 THEN '66-120' END AS band
      FROM s WHERE age_days BETWEEN 0 AND 120)
GROUP BY band""", S_CTE))
def age_bands(spark, d):
    return finish(mk.banded_medians(floored(spark, d), "age_days", "sale_price", AGE_EDGES, AGE_LABELS,
                                    keep_between=(0, 120)))


@register("region_stats", with_sales("""
SELECT borough_name, count(*) AS n, round(avg(sale_price), 4) AS mean, round(median(sale_price), 4) AS median,
       round(avg(gross_sqft), 4) AS mean_gross_sqft, round(avg(year_built), 4) AS mean_year_built,
       min(year_built) AS min_year_built, max(year_built) AS max_year_built
FROM s GROUP BY borough_name""", S_CTE))
def region_stats(spark, d):
    s = floored(spark, d)
    base = mk.multi_stats(s, "borough_name", "sale_price", extra_mean="gross_sqft")
    yb = s.groupBy("borough_name").agg(F.avg("year_built").alias("mean_year_built"),
                                       F.min("year_built").alias("min_year_built"),
                                       F.max("year_built").alias("max_year_built"))
    return finish(base.join(yb, "borough_name", "left"))


@register("price_stats", with_sales("""
SELECT count(sale_price) AS n, round(avg(sale_price), 4) AS mean, round(stddev_samp(sale_price), 4) AS std,
       round(min(sale_price), 4) AS min, round(max(sale_price), 4) AS max,
       round(quantile_cont(sale_price, 0.25), 4) AS q25, round(median(sale_price), 4) AS median,
       round(quantile_cont(sale_price, 0.75), 4) AS q75
FROM s""", S_CTE))
def price_stats(spark, d):
    return finish(mk.price_summary(floored(spark, d), "sale_price"))


@register("yearly_stats", with_sales("""
SELECT sale_year, count(*) AS n, round(avg(sale_price), 4) AS mean FROM s GROUP BY sale_year""", S_CTE))
def yearly_stats(spark, d):
    s = floored(spark, d)
    return finish(s.groupBy("sale_year").agg(F.count("*").alias("n"), F.avg("sale_price").alias("mean")))


@register("distinct_counts", with_sales("""
SELECT count(DISTINCT neighborhood) AS n_neighborhoods, count(DISTINCT building_type) AS n_types,
       count(DISTINCT address) AS n_addresses, count(DISTINCT c_custkey) AS n_buyers FROM s""", S_CTE))
def distinct_counts(spark, d):
    s = floored(spark, d, part=True)
    return finish(mk.distinct_counts(s, {"neighborhood": "n_neighborhoods", "building_type": "n_types",
                                         "address": "n_addresses", "c_custkey": "n_buyers"}))


@register("distinct_sketch", with_sales("""
SELECT sale_year, count(DISTINCT c_custkey) AS n_buyers, true AS within_error FROM s GROUP BY 1""", S_CTE))
def distinct_sketch(spark, d):
    """Buyers of each year from stored monthly sketches, within three standard errors of the exact count."""
    s = floored(spark, d).select("sale_year", "sale_month", "c_custkey")
    stored = materialize(mk.distinct_sketches(s, ["sale_year", "sale_month"], "c_custkey"), "buyer-sketches")
    exact = s.select("sale_year", "c_custkey").distinct().groupBy("sale_year").agg(F.count(F.lit(1)).alias("n_buyers"))
    error = F.abs(F.col("n_distinct") - F.col("n_buyers")) / F.col("n_buyers")
    both = exact.join(mk.distinct_estimate(stored, "sale_year"), "sale_year")
    return finish(both.select("sale_year", "n_buyers", (error <= 3 * 1.04 / 2 ** (mk.SKETCH_BITS / 2)).alias("within_error")))


NULLABLE_SQL = """n AS (
  SELECT nullif(discount, 0) AS discount, nullif(tax, 0) AS tax,
         CASE WHEN gross_sqft > 45 THEN NULL ELSE gross_sqft END AS gross_sqft,
         sale_price, neighborhood
  FROM sales)"""


def _nullable(spark, d):
    s = sales(spark, d)
    return s.select(F.nullif("discount", F.lit(0.0)).alias("discount"),
                    F.nullif("tax", F.lit(0.0)).alias("tax"),
                    F.when(F.col("gross_sqft") > 45, None).otherwise(F.col("gross_sqft")).alias("gross_sqft"),
                    "sale_price", "neighborhood")


@register("null_profile", with_sales("""
SELECT "column", missing, round(missing * 100.0 / total, 4) AS missing_pct FROM (
  SELECT count(*) AS total, count(*) - count(discount) AS discount, count(*) - count(tax) AS tax,
         count(*) - count(gross_sqft) AS gross_sqft, count(*) - count(sale_price) AS sale_price,
         count(*) - count(neighborhood) AS neighborhood FROM n
) UNPIVOT (missing FOR "column" IN (discount, tax, gross_sqft, sale_price, neighborhood))""", NULLABLE_SQL))
def null_profile(spark, d):
    return finish(mk.null_profile(_nullable(spark, d)))


@register("argmax_group", with_sales("""
SELECT neighborhood, round(median, 4) AS median FROM (
  SELECT neighborhood, median(sale_price) AS median FROM s GROUP BY neighborhood)
ORDER BY median DESC, neighborhood LIMIT 1""", S_CTE))
def argmax_group(spark, d):
    m = mk.median_by(floored(spark, d), "neighborhood", "sale_price")
    return finish(mk.argmax_group(m, "neighborhood", "median"))


@register("yoy_pivot", with_sales("""
SELECT borough_name, CAST(sale_year AS BIGINT) AS sale_year, round(m, 4) AS median,
       round((m - prev) / prev * 100, 4) AS yoy_pct, CAST(dense_rank() OVER (ORDER BY sale_year DESC) AS BIGINT) AS years_back
FROM (SELECT *, lag(m) OVER (PARTITION BY borough_name ORDER BY sale_year) AS prev
      FROM (SELECT borough_name, sale_year, median(sale_price) AS m FROM s GROUP BY 1, 2))""", S_CTE))
def yoy_pivot(spark, d):
    return finish(mk.yoy_by_year(floored(spark, d), "borough_name", "sale_year", "sale_price"))


MONTH_SQL = "CAST(date_trunc('month', sale_date) AS DATE)"


@register("monthly_median", with_sales(f"""
SELECT {MONTH_SQL} AS month, borough_name, round(median(sale_price), 4) AS median
FROM s GROUP BY 1, 2""", S_CTE))
def monthly_median(spark, d):
    s = floored(spark, d).withColumn("month", F.trunc("sale_date", "MM"))
    return finish(mk.median_by(s, ["month", "borough_name"], "sale_price"))


@register("monthly_volume", with_sales(f"""
SELECT {MONTH_SQL} AS month, borough_name, count(*) AS n FROM s GROUP BY 1, 2""", S_CTE))
def monthly_volume(spark, d):
    s = floored(spark, d).withColumn("month", F.trunc("sale_date", "MM"))
    return finish(mk.count_by(s, ["month", "borough_name"]))


@register("category_trend", with_sales("""
SELECT sale_year, building_category, round(median(sale_price), 4) AS median
FROM s WHERE building_category IN (
  SELECT building_category FROM s GROUP BY 1 ORDER BY count(*) DESC, building_category LIMIT 5)
GROUP BY 1, 2""", S_CTE))
def category_trend(spark, d):
    s = floored(spark, d, part=True)
    top5 = mk.top_k(mk.count_by(s, "building_category"), [F.desc("n"), "building_category"], 5)
    kept = s.join(F.broadcast(top5.select("building_category")), "building_category", "left_semi")
    return finish(mk.median_by(kept, ["sale_year", "building_category"], "sale_price"))


@register("monthly_mean", with_sales(f"""
SELECT {MONTH_SQL} AS month, count(*) AS n, round(avg(sale_price), 4) AS mean
FROM s GROUP BY 1 HAVING count(*) >= 5""", S_CTE))
def monthly_mean(spark, d):
    s = floored(spark, d).withColumn("month", F.trunc("sale_date", "MM"))
    out = s.groupBy("month").agg(F.count("*").alias("n"), F.avg("sale_price").alias("mean"))
    return finish(out.where(F.col("n") >= 5))


@register("seasonality", with_sales("""
SELECT sale_month, n, n = max(n) OVER () AS is_peak
FROM (SELECT sale_month, count(*) AS n FROM s GROUP BY 1)""", S_CTE))
def seasonality(spark, d):
    return finish(mk.seasonality(floored(spark, d), "sale_month"))


@register("box_stats", with_sales("""
SELECT borough_name, round(q0, 4) AS q0, round(q1, 4) AS q1, round(q2, 4) AS q2, round(q3, 4) AS q3,
       round(q4, 4) AS q4, round(greatest(q0, q1 - 1.5 * (q3 - q1)), 4) AS whisker_lo,
       round(least(q4, q3 + 1.5 * (q3 - q1)), 4) AS whisker_hi
FROM (SELECT borough_name, min(sale_price) AS q0, quantile_cont(sale_price, 0.25) AS q1,
             median(sale_price) AS q2, quantile_cont(sale_price, 0.75) AS q3, max(sale_price) AS q4
      FROM s GROUP BY 1)""", S_CTE))
def box_stats(spark, d):
    return finish(mk.five_numbers(floored(spark, d), "borough_name", "sale_price"))


@register("histogram", with_sales("""
SELECT bin, count(*) AS n, round(lo + bin * (hi - lo) / 50, 4) AS bin_start,
       round(lo + (bin + 1) * (hi - lo) / 50, 4) AS bin_end
FROM (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((sale_price - lo) / ((hi - lo) / 50)), 49) END AS BIGINT) AS bin,
             lo, hi
      FROM s, (SELECT min(sale_price) AS lo, max(sale_price) AS hi FROM s) r)
GROUP BY bin, lo, hi""", S_CTE))
def histogram(spark, d):
    return finish(mk.histogram(floored(spark, d), "sale_price", 50))


@register("export_summary", with_sales("""
SELECT count(*) AS n_rows, CAST(12 AS BIGINT) AS n_columns, min(sale_date) AS first_date,
       max(sale_date) AS last_date FROM s""", S_CTE))
def export_summary(spark, d):
    s = floored(spark, d, part=True).select("borough_name", "neighborhood", "building_type", "building_category",
                                 "address", "sale_price", "gross_sqft", "land_sqft", "total_units",
                                 "sale_date", "year_built", "unit_price")
    return finish(s.agg(F.count("*").alias("n_rows"), F.lit(len(s.columns)).cast("bigint").alias("n_columns"),
                        F.min("sale_date").alias("first_date"), F.max("sale_date").alias("last_date")))


@register("market_contrast", with_sales("""
SELECT round(max(median) / min(median), 4) AS high_low_ratio,
       (SELECT round(max(n) * 100.0 / sum(n), 4) FROM (SELECT count(*) AS n FROM s GROUP BY building_type)) AS top_type_share_pct
FROM (SELECT borough_name, median(sale_price) AS median FROM s GROUP BY 1)""", S_CTE))
def market_contrast(spark, d):
    s = floored(spark, d, part=True)
    med = mk.median_by(s, "borough_name", "sale_price")
    ratio = med.agg(F.try_divide(F.max("median"), F.min("median")).alias("high_low_ratio"))
    share = mk.count_by(s, "building_type").agg(
        (F.max("n") * 100.0 / F.sum("n")).alias("top_type_share_pct"))
    from lotmarket.operators.common import merge_rows
    return finish(merge_rows(ratio, share))


@register("income_summary", with_sales("""
SELECT borough_name, round(avg(buyer_income), 4) AS mean_income, round(median(sale_price), 4) AS median_price,
       round(median(unit_price), 4) AS median_unit_price FROM s GROUP BY 1""", S_CTE))
def income_summary(spark, d):
    s = floored(spark, d)
    inc = s.groupBy("borough_name").agg(F.avg("buyer_income").alias("mean_income"))
    mp = mk.median_by(s, "borough_name", "sale_price", "median_price")
    mu = mk.median_by(s, "borough_name", "unit_price", "median_unit_price")
    return finish(inc.join(mp, "borough_name", "left").join(mu, "borough_name", "left"))


PROFILE_COLS = ["sale_price", "gross_sqft", "land_sqft", "total_units", "discount"]


@register("profile_numeric", with_sales("""
SELECT variable, count(v) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std,
       round(min(v), 4) AS min, round(max(v), 4) AS max, round(var_samp(v), 4) AS variance,
       round(quantile_cont(v, 0.25), 4) AS q25, round(median(v), 4) AS q50, round(quantile_cont(v, 0.75), 4) AS q75,
       round(quantile_cont(v, 0.75) - quantile_cont(v, 0.25), 4) AS iqr
FROM (SELECT * FROM (SELECT CAST(sale_price AS DOUBLE) AS sale_price, CAST(gross_sqft AS DOUBLE) AS gross_sqft,
                            CAST(land_sqft AS DOUBLE) AS land_sqft, CAST(total_units AS DOUBLE) AS total_units,
                            CAST(discount AS DOUBLE) AS discount FROM sales)
      UNPIVOT (v FOR variable IN (sale_price, gross_sqft, land_sqft, total_units, discount)))
GROUP BY variable"""))
def profile_numeric(spark, d):
    return finish(mk.profile_numeric(sales(spark, d), PROFILE_COLS))


# Price categories: the reference's edges (0/100K/500K/1M/5M) on the stand-in
# price scale ($1M -> 50K, as HIGH_PRICE), right-closed.
PRICE_EDGES = [0, 5000, 25000, 50000, 250000, None]
PRICE_LABELS = ["Under $5K", "$5K-$25K", "$25K-$50K", "$50K-$250K", "Over $250K"]
# Building-age categories of the reference (age 0 falls outside).
AGE_CAT_EDGES = [0, 5, 20, 50, 100, None]
AGE_CAT_LABELS = ["New (0-5)", "Modern (5-20)", "Established (20-50)", "Old (50-100)", "Historic (100+)"]


def _case_sql(x, edges, labels):
    parts = []
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = f"{x} > {lo}" + (f" AND {x} <= {hi}" if hi is not None else "")
        parts.append(f"WHEN {cond} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


@register("price_category", with_sales(f"""
SELECT {_case_sql('sale_price', PRICE_EDGES, PRICE_LABELS)} AS price_category, count(*) AS n FROM sales GROUP BY 1"""))
def price_category(spark, d):
    s = sales(spark, d).withColumn("price_category", fx.bin_right_closed("sale_price", PRICE_EDGES, PRICE_LABELS))
    return finish(mk.count_by(s, "price_category"))


@register("age_category", with_sales(f"""
SELECT {_case_sql('age_days', AGE_CAT_EDGES, AGE_CAT_LABELS)} AS age_category, count(*) AS n FROM sales GROUP BY 1"""))
def age_category(spark, d):
    s = sales(spark, d).withColumn("age_category", fx.bin_right_closed("age_days", AGE_CAT_EDGES, AGE_CAT_LABELS))
    return finish(mk.count_by(s, "age_category"))


@register("yoy_last", with_sales("""
SELECT year, prev_year, round(median, 4) AS median, round(prev_median, 4) AS prev_median,
       round((median - prev_median) / prev_median * 100, 4) AS yoy_pct
FROM (SELECT sale_year AS year, lag(sale_year) OVER (ORDER BY sale_year) AS prev_year, m AS median,
             lag(m) OVER (ORDER BY sale_year) AS prev_median
      FROM (SELECT sale_year, median(sale_price) AS m FROM s GROUP BY 1))
WHERE prev_year IS NOT NULL ORDER BY year DESC LIMIT 1""", S_CTE))
def yoy_last(spark, d):
    return finish(mk.yoy_last_two_years(floored(spark, d), "sale_year", "sale_price"))


YOY_YEARS = (1999, 2000)


@register("yoy_fixed", with_sales(f"""
SELECT borough_name, round(b, 4) AS base_median, round(c, 4) AS cur_median, round(coalesce((c - b) / b * 100, 0.0), 4) AS yoy_pct
FROM (SELECT borough_name, median(sale_price) FILTER (WHERE sale_year = {YOY_YEARS[0]}) AS b,
             median(sale_price) FILTER (WHERE sale_year = {YOY_YEARS[1]}) AS c
      FROM s WHERE sale_year IN {YOY_YEARS!r} GROUP BY 1)""", S_CTE))
def yoy_fixed(spark, d):
    return finish(mk.yoy_fixed_years(floored(spark, d), "borough_name", "sale_year", "sale_price", *YOY_YEARS))


@register("star_avg_by_region", """
SELECT r.r_name AS borough_name, count(*) AS n, round(avg(l.l_extendedprice), 4) AS avg_price
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1 ORDER BY avg_price DESC""")
def star_avg_by_region(spark, d):
    li, o, c = (table(spark, d, t) for t in ("lineitem", "orders", "customer"))
    from lotmarket.plans.binding import geo
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == F.col("c_custkey")) \
        .join(F.broadcast(geo(spark, d)), F.col("c_nationkey") == F.col("n_nationkey"))
    out = j.groupBy("borough_name").agg(F.count("*").alias("n"), F.avg("l_extendedprice").alias("avg_price"))
    return finish(out.orderBy(F.desc("avg_price")))
