"""Projection, cast, predicate and scalar-function queries.

Text inputs (numbers written as text, dates in mixed formats, addresses) are
rendered from table columns by the same expressions on both engines, so the
work and the result grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lotmarket.functions import core as fx
from lotmarket.operators import clean as cl
from lotmarket.operators import market as mk
from lotmarket.operators.common import attach, merge_rows
from lotmarket.operators.stats import group_quantiles
from lotmarket.plans.binding import laid_out_sales, sales, star_layout, table, with_sales
from lotmarket.plans.catalog import register
from lotmarket.plans.common import finish
from lotmarket.plans.market_q import S_CTE, floored


def _thousands(n):
    """'1,234' from a non-negative bigint (one separator suffices below 1e6)."""
    hi = ((n - n % 1000) / 1000).cast("bigint")
    return F.when(n >= 1000, F.concat(hi.cast("string"), F.lit(","),
                                      F.lpad((n % 1000).cast("string"), 3, "0"))).otherwise(n.cast("string"))


THOUSANDS_SQL = ("CASE WHEN n >= 1000 THEN CAST(n // 1000 AS VARCHAR) || ',' || lpad(CAST(n % 1000 AS VARCHAR), 3, '0') "
                 "ELSE CAST(n AS VARCHAR) END")


def number_texts(spark, d):
    """Customer balances written in the shapes of the reference's indicator file."""
    c = table(spark, d, "customer")
    n = F.abs(F.col("c_acctbal")).cast("bigint")
    x1 = (F.col("c_custkey") % 500) / 10.0
    k = F.col("c_custkey") % 8
    raw = (F.when(k == 0, F.concat(F.lit("USD "), _thousands(n)))
           .when(k == 1, F.concat(F.lit("$"), _thousands(n)))
           .when(k == 2, F.concat(x1.cast("string"), F.lit(" yrs")))
           .when(k == 3, F.concat(x1.cast("string"), F.lit("%")))
           .when(k == 4, F.concat(n.cast("string"), F.lit(" per 100k")))
           .when(k == 5, F.lit("N/A"))
           .when(k == 6, x1.cast("string"))
           .otherwise(F.lit("")))
    return c.select("c_custkey", raw.alias("raw"))


NUMBER_TEXTS_SQL = f"""t AS (
  SELECT c_custkey,
         CASE c_custkey % 8
           WHEN 0 THEN 'USD' || chr(160) || ({THOUSANDS_SQL})
           WHEN 1 THEN '$' || ({THOUSANDS_SQL})
           WHEN 2 THEN CAST(x1 AS VARCHAR) || ' yrs'
           WHEN 3 THEN CAST(x1 AS VARCHAR) || '%'
           WHEN 4 THEN CAST(n AS VARCHAR) || ' per 100k'
           WHEN 5 THEN 'N/A'
           WHEN 6 THEN CAST(x1 AS VARCHAR)
           ELSE '' END AS raw
  FROM (SELECT c_custkey, CAST(trunc(abs(c_acctbal)) AS BIGINT) AS n, (c_custkey % 500) / 10.0 AS x1 FROM customer))"""

WS = r"[\s\x{00A0}]"


@register("parse_numeric_text", f"""WITH {NUMBER_TEXTS_SQL}
SELECT c_custkey, raw,
  round(coalesce(TRY_CAST(nullif(regexp_extract(regexp_replace(raw, ',|USD|\\$', '', 'g'), '([0-9.]+)', 1), '') AS DOUBLE), 0.0), 4) AS lenient,
  round(TRY_CAST(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(raw), '^USD{WS}*', ''),
        '(?i){WS}*per{WS}+\\d+k.*$', ''), '(?i){WS}+yrs?$', ''), '[%$,]', '', 'g')) AS DOUBLE), 4) AS units,
  round(TRY_CAST(trim(regexp_replace(regexp_replace(regexp_replace(trim(raw), '^USD{WS}*', ''),
        '(?i){WS}*(per{WS}+\\d+k.*|yrs?|%).*', ''), '[$,]', '', 'g')) AS DOUBLE), 4) AS cut
FROM t""")
def parse_numeric_text(spark, d):
    t = number_texts(spark, d)
    return finish(t.select("c_custkey", "raw", fx.parse_number_lenient("raw").alias("lenient"),
                           fx.parse_number_units("raw").alias("units"), fx.parse_number_cut("raw").alias("cut")))


@register("coerce_numeric", f"""WITH {NUMBER_TEXTS_SQL}
SELECT c_custkey, round(TRY_CAST(trim(raw) AS DOUBLE), 4) AS as_double,
       TRY_CAST(trunc(TRY_CAST(trim(raw) AS DOUBLE)) AS INTEGER)::BIGINT AS as_int FROM t""")
def coerce_numeric(spark, d):
    t = number_texts(spark, d)
    return finish(t.select("c_custkey", fx.coerce_numeric("raw").alias("as_double"),
                           fx.coerce_numeric("raw").try_cast("int").alias("as_int")))


@register("safe_int", f"""WITH {NUMBER_TEXTS_SQL}
SELECT c_custkey, CAST(coalesce(TRY_CAST(trunc(TRY_CAST(trim(raw) AS DOUBLE)) AS INTEGER), 0) AS BIGINT) AS value FROM t""")
def safe_int(spark, d):
    t = number_texts(spark, d)
    return finish(t.select("c_custkey", fx.safe_int("raw").alias("value")))


@register("trim_truncate", """
SELECT c_custkey, substring(trim('  ' || c_name || ' ' || c_mktsegment || '  '), 1, 20) AS name20,
       substring(trim(c_mktsegment), 1, 5) AS seg5 FROM customer""")
def trim_truncate(spark, d):
    c = table(spark, d, "customer")
    padded = F.concat(F.lit("  "), F.col("c_name"), F.lit(" "), F.col("c_mktsegment"), F.lit("  "))
    return finish(c.select("c_custkey", fx.trim_truncate(padded, 20).alias("name20"),
                           fx.trim_truncate("c_mktsegment", 5).alias("seg5")))


@register("code_as_text", """
SELECT o_orderkey, split_part(CAST(CAST(o_custkey % 90000 + 10000 AS DOUBLE) AS VARCHAR), '.', 1) AS zip_code
FROM orders""")
def code_as_text(spark, d):
    o = table(spark, d, "orders")
    z = (F.col("o_custkey") % 90000 + 10000).cast("double")
    return finish(o.select("o_orderkey", fx.code_as_text(z).alias("zip_code")))


DATE_TEXT_SQL = """dt AS (
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
         CASE l_linenumber % 4 WHEN 0 THEN strftime(CAST(l_shipdate AS DATE), '%d/%m/%Y')
                               WHEN 1 THEN strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d')
                               WHEN 2 THEN strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') || ' 00:00:00'
                               ELSE 'abc' END AS raw
  FROM lineitem)"""


def date_texts(spark, d):
    li = table(spark, d, "lineitem")
    sd = F.col("l_shipdate").cast("date")
    k = F.col("l_linenumber") % 4
    raw = (F.when(k == 0, F.date_format(sd, "dd/MM/yyyy")).when(k == 1, F.date_format(sd, "yyyy-MM-dd"))
           .when(k == 2, F.concat(F.date_format(sd, "yyyy-MM-dd"), F.lit(" 00:00:00"))).otherwise(F.lit("abc")))
    return li.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), raw.alias("raw"))


@register("parse_dates", f"""WITH {DATE_TEXT_SQL}
SELECT l_orderkey, l_linenumber, raw,
  CAST(coalesce(try_strptime(raw, '%Y-%m-%d %H:%M:%S'), try_strptime(raw, '%Y-%m-%d'),
                try_strptime(raw, '%d/%m/%Y')) AS DATE) AS parsed,
  count(*) FILTER (WHERE coalesce(try_strptime(raw, '%Y-%m-%d %H:%M:%S'), try_strptime(raw, '%Y-%m-%d'),
                try_strptime(raw, '%d/%m/%Y')) IS NULL) OVER () AS n_failed
FROM dt""")
def parse_dates(spark, d):
    t = date_texts(spark, d).withColumn("parsed", fx.parse_date("raw", day_first=True))
    failed = t.agg(F.count_if(F.col("parsed").isNull()).cast("bigint").alias("n_failed"))
    return finish(attach(t, failed))


ISO_TEXT_SQL = """iso AS (
  SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d')
                                         WHEN 1 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%dT12:30:00')
                                         WHEN 2 THEN ' ' || strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d 23:59:59')
                                         WHEN 3 THEN strftime(CAST(o_orderdate AS DATE), '%m/%d/%Y')
                                         ELSE strftime(CAST(o_orderdate AS DATE), '%Y%m') END AS raw
  FROM orders)"""
_ISO = ", ".join(f"try_strptime(trim(raw), '{f}')" for f in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d", "%m/%d/%Y"))


@register("parse_dates_iso", f"""WITH {ISO_TEXT_SQL}
SELECT o_orderkey, raw, CAST(coalesce({_ISO}) AS DATE) AS parsed,
  count(*) FILTER (WHERE coalesce({_ISO}) IS NULL) OVER () AS n_failed FROM iso""")
def parse_dates_iso(spark, d):
    """P9 month first: ISO dates and times, US dates; what no pattern fits is NULL and counted."""
    o = table(spark, d, "orders")
    day, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 5
    raw = (F.when(k == 0, F.date_format(day, "yyyy-MM-dd")).when(k == 1, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T12:30:00")))
           .when(k == 2, F.concat(F.lit(" "), F.date_format(day, "yyyy-MM-dd"), F.lit(" 23:59:59")))
           .when(k == 3, F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "yyyyMM")))
    t = o.select("o_orderkey", raw.alias("raw")).withColumn("parsed", fx.parse_date("raw"))
    return finish(attach(t, t.agg(F.count_if(F.col("parsed").isNull()).cast("bigint").alias("n_failed"))))


@register("star_join", with_sales("SELECT * FROM sales"))
def star_join(spark, d):
    return finish(sales(spark, d))


@register("star_join_bucketed", with_sales("SELECT * FROM sales"))
def star_join_bucketed(spark, d):
    """J1 over tables laid out by order key: the join itself has no exchange."""
    return finish(laid_out_sales(*star_layout(spark, d)))


@register("order_baskets", with_sales("""
SELECT l_orderkey, any_value(borough_name) AS borough_name, count(*) AS n_sales, round(sum(sale_price), 4) AS total_price,
       round(max(sale_price) - min(sale_price), 4) AS price_range, min(sale_date) AS first_sale, max(sale_date) AS last_sale,
       round(any_value(o.o_totalprice), 4) AS o_totalprice, round(sum(sale_price) / any_value(o.o_totalprice), 4) AS price_share
FROM sales JOIN orders o ON o_orderkey = l_orderkey GROUP BY l_orderkey"""))
def order_baskets(spark, d):
    """J1/J2 by order: the laid-out fact is grouped and joined by order key without any exchange."""
    fact, orders = star_layout(spark, d)
    day = F.col("l_shipdate").cast("date")
    sums = fact.groupBy("l_orderkey").agg(
        F.count("*").alias("n_sales"), F.sum("l_extendedprice").alias("total_price"),
        (F.max("l_extendedprice") - F.min("l_extendedprice")).alias("price_range"), F.min(day).alias("first_sale"), F.max(day).alias("last_sale"))
    j = sums.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return finish(j.select("l_orderkey", "borough_name", "n_sales", "total_price", "price_range", "first_sale", "last_sale", "o_totalprice",
                           F.try_divide("total_price", "o_totalprice").alias("price_share")))


@register("price_floor", with_sales("SELECT l_orderkey, l_linenumber, round(sale_price, 4) AS sale_price FROM s", S_CTE))
def price_floor(spark, d):
    return finish(floored(spark, d).select("l_orderkey", "l_linenumber", "sale_price"))


@register("nonpositive_to_null", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CASE WHEN l_discount > 0 THEN l_discount END AS discount,
       CASE WHEN l_tax > 0 THEN l_tax END AS tax FROM lineitem""")
def nonpositive_to_null(spark, d):
    li = table(spark, d, "lineitem")
    return finish(li.select("l_orderkey", "l_linenumber", fx.positive_or_null("l_discount").alias("discount"),
                            fx.positive_or_null("l_tax").alias("tax")))


@register("unit_price", with_sales("""
SELECT l_orderkey, l_linenumber, round(unit_price, 4) AS unit_price FROM s
WHERE unit_price IS NOT NULL AND unit_price < 5000""", S_CTE))
def unit_price(spark, d):
    s = floored(spark, d)
    return finish(s.where(F.col("unit_price").isNotNull() & (F.col("unit_price") < 5000))
                  .select("l_orderkey", "l_linenumber", "unit_price"))


SLICE_REGIONS = ("ASIA", "EUROPE", "AMERICA")


@register("slice_filter", with_sales(f"""
SELECT borough_name, sale_year, count(*) AS n, round(median(sale_price), 4) AS median FROM sales
WHERE borough_name IN {SLICE_REGIONS!r} AND sale_year BETWEEN 1996 AND 1999 AND sale_price BETWEEN 20000 AND 80000
GROUP BY 1, 2"""))
def slice_filter(spark, d):
    s = cl.slice_filter(sales(spark, d, part=False), "borough_name", SLICE_REGIONS, "sale_year", (1996, 1999),
                        "sale_price", (20000, 80000))
    cnt = mk.count_by(s, ["borough_name", "sale_year"])
    return finish(cnt.join(mk.median_by(s, ["borough_name", "sale_year"], "sale_price"),
                           ["borough_name", "sale_year"]))


@register("trim_p5_p95", with_sales("""
SELECT count(*) AS n, round(any_value(lo), 4) AS lo, round(any_value(hi), 4) AS hi,
       round(median(sale_price), 4) AS median
FROM sales, (SELECT quantile_cont(sale_price, 0.05) AS lo, quantile_cont(sale_price, 0.95) AS hi FROM sales) b
WHERE sale_price BETWEEN lo AND hi"""))
def trim_p5_p95(spark, d):
    t = cl.trim_quantiles(sales(spark, d, part=False), "sale_price", 0.05, 0.95)
    out = t.agg(F.count("*").cast("bigint").alias("n"), F.first("_lo").alias("lo"), F.first("_hi").alias("hi"))
    med = group_quantiles(t, None, "sale_price", {"median": 0.5})
    return finish(merge_rows(out, med))


@register("trim_p97", with_sales("""
SELECT count(*) AS n, round(max(sale_price), 4) AS max_price FROM a,
  (SELECT quantile_cont(sale_price, 0.97) AS p97 FROM a) q WHERE sale_price < p97""",
                                   "a AS (SELECT * FROM sales WHERE gross_sqft BETWEEN 2 AND 48)"))
def trim_p97(spark, d):
    t = cl.trim_upper_within(sales(spark, d, part=False), "gross_sqft", (2, 48), "sale_price", 0.97)
    return finish(t.agg(F.count("*").cast("bigint").alias("n"), F.max("sale_price").alias("max_price")))


THRESHOLDS = {"sale_price": (1000.0, 100000.0), "gross_sqft": (1.0, 49.0), "total_units": (1, 49)}


@register("threshold_clean", with_sales("""
SELECT count(*) AS n, round(CAST(sum(CAST(sale_price AS DECIMAL(18,2))) AS DOUBLE), 4) AS total FROM sales
WHERE NOT (sale_price IS NULL AND gross_sqft IS NULL AND total_units IS NULL)
  AND sale_price BETWEEN 1000.0 AND 100000.0 AND gross_sqft BETWEEN 1.0 AND 49.0 AND total_units BETWEEN 1 AND 49"""))
def threshold_clean(spark, d):
    s = sales(spark, d).select("sale_price", "gross_sqft", "total_units")
    t = cl.threshold_clean(s, THRESHOLDS)
    return finish(t.agg(F.count("*").cast("bigint").alias("n"),
                        F.sum(F.col("sale_price").cast("decimal(18,2)")).cast("double").alias("total")))


# English month names for month numbers 1..12 (label table F14).
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August", "September",
               "October", "November", "December"]
# Label table with some categories deliberately absent (-> default).
TYPE_LABELS = {"STANDARD": "Standard stock", "PROMO": "Promotional", "LARGE": "Large lot"}


@register("lookup_default", with_sales("""
SELECT s.sale_month, coalesce(m.label, 'Unknown') AS month_name, s.building_type,
       coalesce(t.label, 'Unknown') AS type_label, count(*) AS n
FROM sales s
LEFT JOIN (VALUES """ + ", ".join(f"({i + 1}, '{n}')" for i, n in enumerate(MONTH_NAMES)) + """) m(k, label)
  ON s.sale_month = m.k
LEFT JOIN (VALUES """ + ", ".join(f"('{k}', '{v}')" for k, v in TYPE_LABELS.items()) + """) t(k, label)
  ON s.building_type = t.k
GROUP BY ALL"""))
def lookup_default(spark, d):
    s = sales(spark, d)
    months = spark.createDataFrame([(i + 1, n) for i, n in enumerate(MONTH_NAMES)], "k bigint, label string")
    types = spark.createDataFrame(list(TYPE_LABELS.items()), "k string, label string")
    j = cl.lookup_with_default(s, "sale_month", months, "month_name", "Unknown")
    j = cl.lookup_with_default(j, "building_type", types, "type_label", "Unknown")
    return finish(j.groupBy("sale_month", "month_name", "building_type", "type_label")
                  .agg(F.count("*").alias("n")))


@register("price_flags", with_sales("""
SELECT sale_price < 1000 AS is_internal_transfer, sale_price > 100000 AS is_luxury, count(*) AS n
FROM sales GROUP BY 1, 2"""))
def price_flags(spark, d):
    s = sales(spark, d).select(cl.flag_below("sale_price", 1000).alias("is_internal_transfer"),
                               cl.flag_above("sale_price", 100000).alias("is_luxury"))
    return finish(s.groupBy("is_internal_transfer", "is_luxury").agg(F.count("*").alias("n")))


@register("prefix_flag", """
SELECT p_partkey, CAST(starts_with(coalesce(p_brand, ''), 'Brand#1') AS INTEGER)::BIGINT AS is_residential FROM part""")
def prefix_flag(spark, d):
    p = table(spark, d, "part")
    return finish(p.select("p_partkey", cl.prefix_flag("p_brand", "Brand#1").alias("is_residential")))


@register("contains_flag", """
SELECT p_partkey, CAST(coalesce(contains(p_name, 'red'), false) AS INTEGER)::BIGINT AS is_condo FROM part""")
def contains_flag(spark, d):
    p = table(spark, d, "part")
    return finish(p.select("p_partkey", cl.contains_flag("p_name", "red").alias("is_condo")))


AS_OF_YEAR = 2001


@register("age_clip", with_sales(f"""
SELECT l_orderkey, l_linenumber, greatest(least(sale_year - year_built, 200), 0) AS building_age,
       CASE WHEN year_built IS NOT NULL THEN greatest({AS_OF_YEAR} - year_built, 0) END AS age_today
FROM sales"""))
def age_clip(spark, d):
    s = sales(spark, d)
    return finish(s.select("l_orderkey", "l_linenumber",
                           fx.clip(F.col("sale_year") - F.col("year_built"), 0, 200).alias("building_age"),
                           F.when(F.col("year_built").isNotNull(),
                                  F.greatest(F.lit(AS_OF_YEAR) - F.col("year_built"), F.lit(0))).alias("age_today")))


@register("amenity_proxy", with_sales("""
SELECT l_orderkey, l_linenumber, round(greatest(least(total_units * 0.15 + 10 / (land_sqft / 100), 10), 1), 4) AS amenity_score
FROM sales"""))
def amenity_proxy(spark, d):
    s = sales(spark, d)
    score = fx.clip(F.col("total_units") * 0.15 + F.lit(10) / (F.col("land_sqft") / 100), 1, 10)
    return finish(s.select("l_orderkey", "l_linenumber", score.alias("amenity_score")))


@register("unit_ratios", with_sales("""
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN total_units > 0 THEN gross_sqft / total_units END, 4) AS sqft_per_unit,
       round(CASE WHEN gross_sqft > 0 THEN (gross_sqft - discount * 100) / gross_sqft END, 4) + 0.0 AS residential_ratio
FROM sales"""))
def unit_ratios(spark, d):
    s = sales(spark, d)
    return finish(s.select("l_orderkey", "l_linenumber",
                           fx.guarded_ratio("gross_sqft", "total_units").alias("sqft_per_unit"),
                           fx.guarded_ratio(F.col("gross_sqft") - F.col("discount") * 100, "gross_sqft")
                           .alias("residential_ratio")))


@register("interaction_features", with_sales("""
SELECT l_orderkey, l_linenumber,
       round(coalesce(CASE WHEN gross_sqft > 40 THEN NULL ELSE gross_sqft END, 0)
             * coalesce(CASE WHEN age_days < 0 THEN NULL ELSE age_days END, 70), 4) AS sqft_x_age,
       round(buyer_income * total_units, 4) AS income_x_amenity
FROM sales"""))
def interaction_features(spark, d):
    s = sales(spark, d)
    sq = F.when(F.col("gross_sqft") > 40, None).otherwise(F.col("gross_sqft"))
    age = F.when(F.col("age_days") < 0, None).otherwise(F.col("age_days"))
    return finish(s.select("l_orderkey", "l_linenumber",
                           (F.coalesce(sq, F.lit(0)) * F.coalesce(age, F.lit(70))).cast("double").alias("sqft_x_age"),
                           (F.col("buyer_income") * F.col("total_units")).alias("income_x_amenity")))


@register("log_transform", with_sales("""
SELECT l_orderkey, l_linenumber, round(ln(1 + sale_price), 4) AS log_price,
       round(exp(ln(1 + sale_price)) - 1, 4) AS back FROM sales"""))
def log_transform(spark, d):
    s = sales(spark, d)
    return finish(s.select("l_orderkey", "l_linenumber", fx.log1p("sale_price").alias("log_price"),
                           fx.expm1(fx.log1p("sale_price")).alias("back")))


@register("text_normalize", """
SELECT c_custkey, upper(trim('  ' || c_name || ' ')) AS name, upper(trim(c_mktsegment)) AS segment,
       trim(' ' || lower(c_mktsegment)) AS segment_lower FROM customer""")
def text_normalize(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey", F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("name"),
        F.col("c_mktsegment").alias("segment"), F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("segment_lower"))
    t = cl.trim_text_columns(c)
    return finish(t.select("c_custkey", F.upper("name").alias("name"), F.upper("segment").alias("segment"),
                           "segment_lower"))


ADDRESS_SQL = "(CAST(p_partkey AS VARCHAR) || '-12 o''' || p_name || ' ST/' || p_type)"


def _title_sql(x: str) -> str:
    return ("array_to_string(list_transform(regexp_extract_all(" + x + r", '(\p{L}+|[^\p{L}]+)'), "
            "lambda z: upper(z[1]) || lower(z[2:])), '')")


@register("title_case", f"""
SELECT p_partkey, {_title_sql(ADDRESS_SQL)} AS address, substring({_title_sql(ADDRESS_SQL)}, 1, 25) AS label
FROM part""")
def title_case(spark, d):
    p = table(spark, d, "part")
    addr = F.concat(F.col("p_partkey").cast("string"), F.lit("-12 o'"), F.col("p_name"), F.lit(" ST/"),
                    F.col("p_type"))
    t = fx.title_case(addr)
    return finish(p.select("p_partkey", t.alias("address"), F.substring(t, 1, 25).alias("label")))


SUFFIXES = ["HEIGHTS", "VILLAGE", "AREA", "DISTRICT"]


@register("strip_suffix", """
SELECT c_custkey, regexp_replace(upper(c_mktsegment) || CASE c_custkey % 5 WHEN 0 THEN ' HEIGHTS'
         WHEN 1 THEN ' VILLAGE' WHEN 2 THEN '  AREA' ELSE '' END, '\\s+(HEIGHTS|VILLAGE|AREA|DISTRICT)$', '') AS name
FROM customer""")
def strip_suffix(spark, d):
    c = table(spark, d, "customer")
    k = F.col("c_custkey") % 5
    name = F.concat(F.upper("c_mktsegment"), F.when(k == 0, " HEIGHTS").when(k == 1, " VILLAGE")
                    .when(k == 2, "  AREA").otherwise(""))
    return finish(c.select("c_custkey", fx.strip_suffix(name, SUFFIXES).alias("name")))


@register("date_parts", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(year(l_shipdate) AS BIGINT) AS year,
       CAST(month(l_shipdate) AS BIGINT) AS month, CAST(quarter(l_shipdate) AS BIGINT) AS quarter,
       CAST(isodow(l_shipdate) - 1 AS BIGINT) AS day_of_week FROM lineitem""")
def date_parts(spark, d):
    li = table(spark, d, "lineitem")
    sd = F.col("l_shipdate").cast("date")
    return finish(li.select("l_orderkey", "l_linenumber", F.year(sd).alias("year"), F.month(sd).alias("month"),
                            F.quarter(sd).alias("quarter"), fx.weekday_mon0(sd).alias("day_of_week")))


@register("month_start", with_sales("""
SELECT make_date(CAST(sale_year AS INTEGER), CAST(sale_month AS INTEGER), 1) AS month_start,
       strftime(CAST(date_trunc('month', sale_date) AS DATE), '%Y-%m') AS period, count(*) AS n
FROM sales GROUP BY 1, 2"""))
def month_start(spark, d):
    s = sales(spark, d)
    out = s.select(fx.month_start(F.col("sale_year").cast("int"), F.col("sale_month").cast("int")).alias("month_start"),
                   F.date_format(F.trunc("sale_date", "MM"), "yyyy-MM").alias("period"))
    return finish(out.groupBy("month_start", "period").agg(F.count("*").alias("n")))


@register("clip", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CASE WHEN l_discount = 0 THEN NULL ELSE greatest(least(l_extendedprice, 80000.0), 20000.0) END AS clipped
FROM lineitem""")
def clip(spark, d):
    li = table(spark, d, "lineitem")
    v = F.when(F.col("l_discount") == 0, None).otherwise(F.col("l_extendedprice"))
    return finish(li.select("l_orderkey", "l_linenumber", fx.clip(v, 20000.0, 80000.0).alias("clipped")))


@register("round_half_even", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, round_even(l_extendedprice / 8, 2) AS r2,
       round_even(l_quantity / 2, 0) AS r0 FROM lineitem""")
def round_half_even(spark, d):
    li = table(spark, d, "lineitem")
    return finish(li.select("l_orderkey", "l_linenumber",
                            fx.round_half_even(F.col("l_extendedprice") / 8, 2).alias("r2"),
                            fx.round_half_even(F.col("l_quantity") / 2, 0).alias("r0")))


def _adler_sql(x: str) -> str:
    chars = f"list_transform(range(1, length({x}) + 1), lambda i: unicode(substr({x}, i, 1)))"
    weighted = f"list_transform(range(1, length({x}) + 1), lambda i: (length({x}) - i + 1) * unicode(substr({x}, i, 1)))"
    a = f"((1 + coalesce(list_sum({chars}), 0)) % 65521)"
    b = f"((length({x}) + coalesce(list_sum({weighted}), 0)) % 65521)"
    return f"CAST({b} * 65536 + {a} AS BIGINT)"


@register("adler32_fold", f"""
SELECT p_partkey, upper(p_name) AS name, {_adler_sql('upper(p_name)')} AS h FROM part""")
def adler32_fold(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.upper("p_name").alias("name"))
    return finish(p.select("p_partkey", "name", fx.adler32("name").alias("h")))


@register("money_label", with_sales("""
SELECT borough_name, printf('$%.2fM', median(sale_price) * 100 / 1e6) AS label FROM s GROUP BY 1""", S_CTE))
def money_label(spark, d):
    m = mk.median_by(floored(spark, d), "borough_name", "sale_price")
    return finish(m.select("borough_name", fx.money_label(F.col("median") * 100).alias("label")))


@register("split_key", """
SELECT key, split_part(key, '_', 1) AS region,
       CASE WHEN strpos(key, '_') > 0 THEN substr(key, strpos(key, '_') + 1) END AS area
FROM (SELECT r.r_name || '_' || n.n_name AS key FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)""")
def split_key(spark, d):
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    k = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        F.concat(F.col("r_name"), F.lit("_"), F.col("n_name")).alias("key"))
    head, tail = fx.split_key("key")
    return finish(k.select("key", head.alias("region"), tail.alias("area")))


# Land area in square km per region number 1..5.
AREA_SQKM = {1: 59.1, 2: 109.0, 3: 183.4, 4: 281.5, 5: 151.5}


@register("density", """
SELECT r.r_name AS region, CAST(count(*) AS BIGINT) AS population,
       round_even(count(*) / any_value(a.km2), 0) AS density
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN (VALUES """ + ", ".join(f"({k}, {v})" for k, v in AREA_SQKM.items()) + """) a(k, km2) ON r.r_regionkey + 1 = a.k
GROUP BY 1""")
def density(spark, d):
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    areas = spark.createDataFrame(list(AREA_SQKM.items()), "k int, km2 double")
    pop = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey) \
        .join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey")) \
        .groupBy(F.col("r_name").alias("region"), (F.col("r_regionkey") + 1).alias("k")) \
        .agg(F.count("*").cast("bigint").alias("population"))
    out = pop.join(F.broadcast(areas), "k")
    return finish(out.select("region", "population",
                             fx.round_half_even(fx.guarded_ratio("population", "km2"), 0).alias("density")))
