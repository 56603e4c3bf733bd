"""Trend, return and correlation queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lotmarket.operators import market as mk
from lotmarket.operators import trend as tr
from lotmarket.operators.common import attach
from lotmarket.operators.warehouse import dense_ids
from lotmarket.plans.binding import with_sales
from lotmarket.plans.catalog import register
from lotmarket.plans.common import finish
from lotmarket.plans.market_q import S_CTE, floored

M_CTE = S_CTE + """,
m AS (SELECT neighborhood, CAST(date_trunc('month', sale_date) AS DATE) AS month, count(*) AS n,
             median(sale_price) AS median FROM s GROUP BY 1, 2),
r AS (SELECT neighborhood, arg_min(median, month) AS start, arg_max(median, month) AS "end",
             regr_slope(median, CAST(date_diff('day', DATE '1970-01-01', month) AS DOUBLE)) AS slope,
             CASE WHEN var_pop(median) = 0 THEN 0.0
                  ELSE regr_r2(median, CAST(date_diff('day', DATE '1970-01-01', month) AS DOUBLE)) END AS r2,
             count(*) AS months, sum(n) AS n
      FROM m GROUP BY 1 HAVING count(*) >= 3 AND sum(n) >= 10),
rt AS (SELECT *, ("end" - start) / start * 100 AS return_pct,
              round_even(least(n / 100.0 * 40, 40.0) + least(months / 12.0 * 30, 30.0)
                         + least(coalesce(r2, 0.0) * 30, 30.0), 0) AS confidence FROM r)"""

RT_COLS = ("neighborhood, round(start, 4) AS start, round(\"end\", 4) AS \"end\", round(slope, 4) AS slope, "
           "round(r2, 4) AS r2, months, CAST(n AS BIGINT) AS n, round(return_pct, 4) AS return_pct")


def returns(spark, d):
    s = floored(spark, d)
    series = tr.monthly_medians(s, "neighborhood", "sale_date", "sale_price")
    out = tr.returns_table(series, "neighborhood", min_months=3, min_n=10)
    return out.withColumn("confidence", tr.confidence())


@register("neighborhood_returns", with_sales(f"SELECT {RT_COLS} FROM rt", M_CTE))
def neighborhood_returns(spark, d):
    return finish(returns(spark, d).drop("confidence"))


@register("confidence_score", with_sales("""
SELECT neighborhood, round(confidence, 4) AS confidence,
       CASE WHEN confidence >= 80 THEN 'high' WHEN confidence >= 60 THEN 'medium' ELSE 'low' END AS rating
FROM rt""", M_CTE))
def confidence_score(spark, d):
    r = returns(spark, d)
    return finish(r.select("neighborhood", "confidence", tr.confidence_rating("confidence").alias("rating")))


@register("top_bottom_returns", with_sales(f"""
SELECT * FROM (SELECT 'top' AS side, {RT_COLS} FROM rt ORDER BY return_pct DESC, neighborhood LIMIT 3)
UNION ALL
SELECT * FROM (SELECT 'bottom' AS side, {RT_COLS} FROM rt ORDER BY return_pct ASC, neighborhood LIMIT 3)""",
                                             M_CTE))
def top_bottom_returns(spark, d):
    r = returns(spark, d).drop("confidence")
    top = mk.top_k(r, [F.desc("return_pct"), "neighborhood"], 3).withColumn("side", F.lit("top"))
    bottom = mk.top_k(r, [F.asc("return_pct"), "neighborhood"], 3).withColumn("side", F.lit("bottom"))
    return finish(top.unionByName(bottom))


@register("steady_trends", with_sales(f"""
SELECT direction, {RT_COLS} FROM (
  SELECT *, CASE WHEN slope > 0 THEN 'rising' ELSE 'falling' END AS direction,
         row_number() OVER (PARTITION BY slope > 0 ORDER BY r2 DESC, neighborhood) AS rk
  FROM rt WHERE months >= 5 AND n >= 30 AND slope <> 0)
WHERE rk = 1""", M_CTE))
def steady_trends(spark, d):
    r = returns(spark, d).drop("confidence")
    r = r.where((F.col("months") >= 5) & (F.col("n") >= 30) & (F.col("slope") != 0))
    r = r.withColumn("direction", F.when(F.col("slope") > 0, "rising").otherwise("falling"))
    best = mk.top_k_per_group(r, "direction", [F.desc("r2"), "neighborhood"], 1, "rk")
    return finish(best.drop("rk"))


@register("leaderboard", with_sales("""
SELECT neighborhood, round(return_pct, 4) AS return_pct, round(confidence, 4) AS confidence,
       CASE WHEN confidence >= 80 THEN 'high' WHEN confidence >= 60 THEN 'medium' ELSE 'low' END AS rating,
       CAST(row_number() OVER (ORDER BY confidence DESC, neighborhood) AS BIGINT) AS position
FROM rt WHERE n >= 30 AND months >= 5""", M_CTE))
def leaderboard(spark, d, names=None):
    """Areas with enough sales and months; ``names`` narrows the board to those asked for."""
    r = returns(spark, d).where((F.col("n") >= 30) & (F.col("months") >= 5))
    if names:
        r = r.where(F.col("neighborhood").isin(*names))
    r = r.select("neighborhood", "return_pct", "confidence", tr.confidence_rating("confidence").alias("rating"))
    return finish(dense_ids(r, [F.desc("confidence"), "neighborhood"], "position"))


REGION_M_CTE = S_CTE + """,
rm AS (SELECT borough_name, CAST(date_trunc('month', sale_date) AS DATE) AS month, count(*) AS n,
              median(sale_price) AS median FROM s GROUP BY 1, 2)"""


@register("returns_by_region", with_sales("""
SELECT borough_name, round(arg_min(median, month), 4) AS start, round(arg_max(median, month), 4) AS "end",
       round((arg_max(median, month) - arg_min(median, month)) / arg_min(median, month) * 100, 4) AS return_pct,
       count(*) AS months
FROM rm GROUP BY 1""", REGION_M_CTE))
def returns_by_region(spark, d):
    series = tr.monthly_medians(floored(spark, d), "borough_name", "sale_date", "sale_price")
    out = series.groupBy("borough_name").agg(
        F.min_by("median", "month").alias("start"), F.max_by("median", "month").alias("end"),
        F.count("*").cast("bigint").alias("months"))
    return finish(out.withColumn("return_pct", (F.col("end") - F.col("start")) / F.col("start") * 100))


@register("growth_index", with_sales("""
SELECT borough_name, month, round(median, 4) AS median,
       round((median - first_value(median) OVER w) / first_value(median) OVER w * 100, 4) AS index_pct
FROM rm WINDOW w AS (PARTITION BY borough_name ORDER BY month)""", REGION_M_CTE))
def growth_index(spark, d):
    series = tr.monthly_medians(floored(spark, d), "borough_name", "sale_date", "sale_price").drop("n")
    return finish(tr.growth_index(series, "borough_name"))


@register("fill_gaps", with_sales("""
SELECT neighborhood, building_category, g.month, m.median IS NULL AS filled,
       round(coalesce(last_value(m.median IGNORE NULLS) OVER (PARTITION BY neighborhood, building_category
                 ORDER BY g.month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                      first_value(m.median IGNORE NULLS) OVER (PARTITION BY neighborhood, building_category
                 ORDER BY g.month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 4) AS median
FROM (SELECT neighborhood, building_category,
             CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month
      FROM mc GROUP BY 1, 2) g
LEFT JOIN mc m USING (neighborhood, building_category, month)""", S_CTE + """,
mc AS (SELECT neighborhood, building_category, CAST(date_trunc('month', sale_date) AS DATE) AS month,
              median(sale_price) AS median FROM s GROUP BY 1, 2, 3)"""))
def fill_gaps(spark, d):
    keys = ["neighborhood", "building_category"]
    series = tr.monthly_medians(floored(spark, d, part=True), keys, "sale_date", "sale_price").drop("n")
    return finish(tr.fill_gaps(series, keys))


@register("trend_line", with_sales("""
SELECT borough_name, round(regr_slope(median, x), 4) AS slope, round(regr_intercept(median, x), 4) AS intercept,
       round(CASE WHEN var_pop(median) = 0 THEN 0.0 ELSE regr_r2(median, x) END, 4) AS r2,
       CAST(regr_count(median, x) AS BIGINT) AS n
FROM (SELECT *, CAST(date_diff('day', DATE '1970-01-01', month) AS DOUBLE) AS x FROM rm)
GROUP BY 1""", REGION_M_CTE))
def trend_line(spark, d):
    series = tr.monthly_medians(floored(spark, d), "borough_name", "sale_date", "sale_price")
    series = series.withColumn("x", F.unix_date("month").cast("double"))
    return finish(tr.ols_by_group(series, "borough_name", "median", "x"))


POLY_CTE = S_CTE + """,
mm AS (SELECT borough_name, CAST(row_number() OVER (PARTITION BY borough_name ORDER BY ym) - 1 AS BIGINT) AS t, y FROM (
       SELECT borough_name, sale_year * 12 + sale_month AS ym, avg(sale_price) AS y
       FROM s GROUP BY 1, 2 HAVING count(*) >= 5)),
c AS (SELECT *, t - avg(t) OVER (PARTITION BY borough_name) AS u, avg(t) OVER (PARTITION BY borough_name) AS tm FROM mm),
p AS (SELECT borough_name, count(y) AS n, sum(u*u) AS S2, sum(u*u*u) AS S3, sum(u*u*u*u) AS S4,
             sum(y) AS T0, sum(u*y) AS T1, sum(u*u*y) AS T2, any_value(tm) AS tm, max(t) AS t_last
      FROM c GROUP BY 1 HAVING count(y) >= 4),
b AS (SELECT *, (n*(S2*T2 - S3*T1) - S2*S2*T0) / (n*(S2*S4 - S3*S3) - S2*S2*S2) AS b2 FROM p),
coef AS (SELECT borough_name, tm, t_last, (T0 - b2*S2)/n AS b0, (T1 - b2*S3)/S2 AS b1, b2 FROM b),
sig AS (SELECT c.borough_name, sqrt(avg(power(c.y - (b0 + b1*c.u + b2*c.u*c.u), 2))) AS sigma
        FROM c JOIN coef USING (borough_name) GROUP BY 1)"""


@register("poly_forecast", with_sales("""
SELECT borough_name, CAST(step AS BIGINT) AS step, round(f, 4) AS forecast, round(f - 1.5*sigma, 4) AS lower,
       round(f + 1.5*sigma, 4) AS upper
FROM (SELECT borough_name, step, sigma,
             b0 + b1*(t_last + step - tm) + b2*(t_last + step - tm)*(t_last + step - tm) AS f
      FROM coef JOIN sig USING (borough_name), range(1, 7) AS r(step))""", POLY_CTE))
def poly_forecast(spark, d):
    s = floored(spark, d).withColumn("ym", F.col("sale_year") * 12 + F.col("sale_month"))
    mm = s.groupBy("borough_name", "ym").agg(F.count("*").alias("_c"), F.avg("sale_price").alias("y")) \
        .where(F.col("_c") >= 5).drop("_c")
    # months are numbered after the filter, so a gap doesn't stretch the curve; a row per region and month
    mm = mm.withColumn("t", (F.row_number().over(Window.partitionBy("borough_name").orderBy("ym")) - 1).cast("bigint")).drop("ym")
    return finish(tr.poly_forecast(mm, "borough_name", "t", "y", horizon=6, min_points=4))


# The series of all regions together, as one more region.
ALL_CTE = S_CTE.replace("s AS (", "s0 AS (", 1) + """,
s AS (SELECT sale_year, sale_month, sale_price, borough_name FROM s0 UNION ALL SELECT sale_year, sale_month, sale_price, 'ALL' FROM s0)""" + POLY_CTE[len(S_CTE):]


@register("forecast_history", with_sales("""
SELECT c.borough_name, c.t, round(f, 4) AS fitted, round(f - sigma, 4) AS lower, round(f + sigma, 4) AS upper
FROM (SELECT c.*, b0 + b1*c.u + b2*c.u*c.u AS f, sigma FROM c JOIN coef USING (borough_name) JOIN sig USING (borough_name)) c""", ALL_CTE))
def forecast_history(spark, d):
    """The fitted past of each region's series and of all regions' together, with bands of one sigma."""
    s = floored(spark, d).select((F.col("sale_year") * 12 + F.col("sale_month")).alias("ym"), "sale_price",
                                 F.explode(F.array("borough_name", F.lit("ALL"))).alias("borough_name"))
    mm = s.groupBy("borough_name", "ym").agg(F.count("*").alias("_c"), F.avg("sale_price").alias("y")).where(F.col("_c") >= 5).drop("_c")
    mm = mm.withColumn("t", (F.row_number().over(Window.partitionBy("borough_name").orderBy("ym")) - 1).cast("bigint")).drop("ym")
    return finish(tr.poly_forecast(mm, "borough_name", "t", "y", min_points=4, history=True).drop("actual"))


@register("quarter_projection", with_sales("""
SELECT borough_name, CAST(q AS BIGINT) AS quarter, round(v, 4) AS value, projected,
       round((v - lag(v) OVER (PARTITION BY borough_name ORDER BY q)) / lag(v) OVER (PARTITION BY borough_name ORDER BY q) * 100, 4) AS qoq_pct
FROM (
  SELECT borough_name, q, m AS v, false AS projected FROM qm WHERE m IS NOT NULL
  UNION ALL
  SELECT f.borough_name, r.q, f.a + f.b * r.q AS v, true AS projected
  FROM fit f, range(5, 9) AS r(q))""", S_CTE + """,
qq AS (SELECT borough_name, sale_price, CAST(year(sale_date) * 4 + quarter(sale_date) AS BIGINT) AS qi FROM s),
qm AS (SELECT borough_name, qi - (SELECT max(qi) FROM qq) + 4 AS q, median(sale_price) AS m
       FROM qq WHERE qi > (SELECT max(qi) FROM qq) - 4 GROUP BY 1, 2),
fit AS (SELECT borough_name, regr_intercept(m, q) AS a, regr_slope(m, q) AS b
        FROM qm GROUP BY 1 HAVING count(m) >= 3)"""))
def quarter_projection(spark, d):
    """A line through the last four quarters that there are (quarters 1 to 4, across a year's end) and four more."""
    s = floored(spark, d).withColumn("qi", F.year("sale_date") * 4 + F.quarter("sale_date"))
    s = attach(s, s.agg(F.max("qi").alias("last"))).withColumn("q", (F.col("qi") - F.col("last") + 4).cast("bigint")).where("q > 0")
    qm = mk.median_by(s, ["borough_name", "q"], "sale_price", "m")
    fit = qm.groupBy("borough_name").agg(F.regr_intercept("m", F.col("q").cast("double")).alias("a"),
                                         F.regr_slope("m", F.col("q").cast("double")).alias("b"),
                                         F.count("m").alias("_c")).where(F.col("_c") >= 3)
    proj = fit.select("borough_name", F.explode(F.sequence(F.lit(5).cast("bigint"), F.lit(8).cast("bigint"))).alias("q"), "a", "b") \
        .select("borough_name", "q", (F.col("a") + F.col("b") * F.col("q")).alias("v"), F.lit(True).alias("projected"))
    act = qm.select("borough_name", "q", F.col("m").alias("v"), F.lit(False).alias("projected"))
    allq = act.unionByName(proj)
    w = Window.partitionBy("borough_name").orderBy("q")
    prev = F.lag("v").over(w)
    out = allq.select("borough_name", F.col("q").alias("quarter"), F.col("v").alias("value"), "projected",
                      ((F.col("v") - prev) / prev * 100).alias("qoq_pct"))
    return finish(out)


FACTORS = ["gross_sqft", "land_sqft", "total_units", "discount", "tax", "age_days", "buyer_income"]


@register("corr_pairs", with_sales("""
SELECT borough_name, round(covar_samp(sale_price, gross_sqft) / (stddev_samp(sale_price) * stddev_samp(gross_sqft)), 4) AS r,
       count(*) AS n
FROM s GROUP BY 1 HAVING count(*) >= 20""", S_CTE))
def corr_pairs(spark, d):
    s = floored(spark, d)
    out = s.groupBy("borough_name").agg(tr.safe_corr("sale_price", "gross_sqft").alias("r"),
                                        F.count("*").cast("bigint").alias("n"))
    return finish(out.where(F.col("n") >= 20))


@register("factor_ranking", with_sales("""
SELECT factor, n, round_even(r, 2) AS r,
       CASE WHEN r IS NULL THEN NULL WHEN abs(r) >= 0.5 THEN 'strong' WHEN abs(r) >= 0.35 THEN 'moderate'
            WHEN abs(r) >= 0.15 THEN 'weak' ELSE 'none' END AS strength,
       CASE WHEN r > 0 THEN 'positive' WHEN r < 0 THEN 'negative' ELSE 'none' END AS direction,
       round(abs(r), 4) AS abs_r
FROM (SELECT factor, covar_samp(y, x) / (stddev_samp(x) * stddev_samp(y)) AS r, count(x) AS n
      FROM (SELECT CAST(sale_price AS DOUBLE) AS y, * EXCLUDE (sale_price) FROM
              (SELECT sale_price, """ + ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in FACTORS) + """ FROM s)
            UNPIVOT (x FOR factor IN (""" + ", ".join(FACTORS) + """)))
      GROUP BY factor HAVING count(x) >= 20)""", S_CTE))
def factor_ranking(spark, d):
    return finish(tr.factor_ranking(floored(spark, d, part=True), "sale_price", FACTORS))


MATRIX_COLS = ["sale_price", "gross_sqft", "land_sqft", "total_units", "discount", "age_days", "buyer_income"]


@register("corr_matrix", with_sales(
    "SELECT var_a, var_b, round(r, 4) AS r FROM (SELECT "
    + ", ".join(f"covar_samp({a}, {b}) / (stddev_samp({a}) * stddev_samp({b})) AS \"{a}__{b}\""
                for a in MATRIX_COLS for b in MATRIX_COLS)
    + " FROM s) UNPIVOT (r FOR pair IN ("
    + ", ".join(f'"{a}__{b}"' for a in MATRIX_COLS for b in MATRIX_COLS)
    + ")) CROSS JOIN LATERAL (SELECT split_part(pair, '__', 1) AS var_a, split_part(pair, '__', 2) AS var_b)",
    S_CTE))
def corr_matrix(spark, d):
    return finish(tr.corr_matrix(floored(spark, d, part=True), MATRIX_COLS))


@register("predicted_vs_actual", with_sales("""
SELECT round(regr_slope(y, p), 4) AS slope, round(regr_intercept(y, p), 4) AS intercept,
       round(regr_r2(y, p), 4) AS r2, CAST(regr_count(y, p) AS BIGINT) AS n
FROM (SELECT s.sale_price AS y, f.a + f.b * s.gross_sqft AS p FROM s,
        (SELECT regr_intercept(sale_price, gross_sqft) AS a, regr_slope(sale_price, gross_sqft) AS b FROM s) f)""",
                                              S_CTE))
def predicted_vs_actual(spark, d):
    s = floored(spark, d)
    from lotmarket.operators.common import attach
    fit = tr.ols_by_group(s, None, "sale_price", "gross_sqft").select(
        F.col("intercept").alias("a"), F.col("slope").alias("b"))
    p = attach(s, fit) \
        .select(F.col("sale_price").alias("y"), (F.col("a") + F.col("b") * F.col("gross_sqft")).alias("p"))
    return finish(tr.ols_by_group(p, None, "y", "p"))
