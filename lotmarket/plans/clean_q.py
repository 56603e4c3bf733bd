"""Cleaning queries: imputation, clamps, sparse columns, audit,
and the three end-to-end cleaning compositions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotmarket.functions import core as fx
from lotmarket.operators import clean as cl
from lotmarket.operators import relational as rel
from lotmarket.plans.binding import sales, sales_by_order, with_sales
from lotmarket.plans.catalog import register
from lotmarket.plans.common import finish
from lotmarket.sources.files import materialize
from lotmarket.plans.relational_q import IND_CTES, indicators_wide

# A sales frame with missing values made from the data (the driver tables have none).
RAW_SQL = """raw AS (
  SELECT l_orderkey, l_linenumber, borough_name, neighborhood,
         CASE WHEN tax = 0 THEN NULL ELSE building_type END AS building_type,
         address, sale_price,
         CASE WHEN discount = 0 THEN NULL ELSE gross_sqft END AS gross_sqft,
         CASE WHEN tax > 0.07 THEN NULL ELSE land_sqft END AS land_sqft,
         total_units, year_built, sale_date,
         CASE WHEN flag = 'R' THEN address END AS apartment,
         CAST(NULL AS VARCHAR) AS easement
  FROM sales)"""


def raw_frame(spark, d, by_order=False):
    s = sales_by_order(spark, d) if by_order else sales(spark, d)
    return s.select("l_orderkey", "l_linenumber", "borough_name", "neighborhood",
                    F.when(F.col("tax") == 0, None).otherwise(F.col("building_type")).alias("building_type"),
                    "address", "sale_price",
                    F.when(F.col("discount") == 0, None).otherwise(F.col("gross_sqft")).alias("gross_sqft"),
                    F.when(F.col("tax") > 0.07, None).otherwise(F.col("land_sqft")).alias("land_sqft"),
                    "total_units", "year_built", "sale_date",
                    F.when(F.col("flag") == "R", F.col("address")).alias("apartment"),
                    F.lit(None).cast("string").alias("easement"))


def _sq(col: str) -> str:
    return f"(SELECT median({col}) FROM raw)"


@register("impute_median", with_sales(f"""
SELECT l_orderkey, l_linenumber, round(coalesce(gross_sqft, {_sq('gross_sqft')}), 4) AS gross_sqft,
       round(coalesce(land_sqft, {_sq('land_sqft')}), 4) AS land_sqft FROM raw""", RAW_SQL))
def impute_median(spark, d):
    r = raw_frame(spark, d).select("l_orderkey", "l_linenumber", "gross_sqft", "land_sqft")
    return finish(cl.impute_median(r, ["gross_sqft", "land_sqft"]))


MODE_SQL = ("(SELECT building_type FROM raw WHERE building_type IS NOT NULL GROUP BY 1 "
            "ORDER BY count(*) DESC, building_type LIMIT 1)")


@register("impute_mode", with_sales(f"""
SELECT l_orderkey, l_linenumber, coalesce(building_type, {MODE_SQL}) AS building_type FROM raw""", RAW_SQL))
def impute_mode(spark, d):
    r = raw_frame(spark, d).select("l_orderkey", "l_linenumber", "building_type")
    return finish(cl.impute_mode(r, ["building_type"]))


# Constant fills of the reference (zip 11205, units 1/0/1, unknown text).
CONST_FILL = {"gross_sqft": 1.0, "land_sqft": 0.0, "building_type": "UNKNOWN", "apartment": "UNKNOWN"}


@register("impute_const", with_sales("""
SELECT l_orderkey, l_linenumber, coalesce(gross_sqft, 1.0) AS gross_sqft, coalesce(land_sqft, 0.0) AS land_sqft,
       coalesce(building_type, 'UNKNOWN') AS building_type, coalesce(apartment, 'UNKNOWN') AS apartment FROM raw""",
                                        RAW_SQL))
def impute_const(spark, d):
    r = raw_frame(spark, d).select("l_orderkey", "l_linenumber", "gross_sqft", "land_sqft", "building_type",
                                   "apartment")
    return finish(cl.impute_const(r, CONST_FILL))


def _iqr_sql(c: str) -> str:
    q1 = f"(SELECT quantile_cont({c}, 0.25) FROM raw)"
    q3 = f"(SELECT quantile_cont({c}, 0.75) FROM raw)"
    return (f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, {q1} - 1.5 * ({q3} - {q1})), "
            f"{q3} + 1.5 * ({q3} - {q1})) END")


IQR_COLS = ["sale_price", "gross_sqft", "land_sqft"]


@register("iqr_clip", with_sales(
    "SELECT l_orderkey, l_linenumber, " + ", ".join(f"round({_iqr_sql(c)}, 4) AS {c}" for c in IQR_COLS)
    + " FROM raw", RAW_SQL))
def iqr_clip(spark, d):
    r = raw_frame(spark, d).select("l_orderkey", "l_linenumber", *IQR_COLS)
    return finish(cl.iqr_clip(r, IQR_COLS))


@register("drop_sparse_cols", with_sales("""
SELECT l_orderkey, l_linenumber, borough_name, neighborhood, building_type, address, round(sale_price, 4) AS sale_price,
       round(gross_sqft, 4) AS gross_sqft, round(land_sqft, 4) AS land_sqft, total_units, year_built, sale_date
FROM raw""", RAW_SQL))
def drop_sparse_cols(spark, d):
    return finish(cl.drop_sparse(raw_frame(spark, d), 50.0))


DEGEN_COLS = ["easement", "city", "sale_price", "building_type", "apartment"]


@register("degenerate_cols", with_sales("""
SELECT "column", non_null, "distinct", non_null = 0 AS all_missing, "distinct" = 1 AS constant FROM (
  SELECT 'easement' AS "column", count(easement) AS non_null, count(DISTINCT easement) AS "distinct" FROM raw
  UNION ALL SELECT 'city', count(*), 1 FROM raw
  UNION ALL SELECT 'sale_price', count(sale_price), count(DISTINCT sale_price) FROM raw
  UNION ALL SELECT 'building_type', count(building_type), count(DISTINCT building_type) FROM raw
  UNION ALL SELECT 'apartment', count(apartment), count(DISTINCT apartment) FROM raw)""", RAW_SQL))
def degenerate_cols(spark, d):
    r = raw_frame(spark, d).withColumn("city", F.lit("NY"))
    return finish(cl.degenerate_columns(r, DEGEN_COLS))


# Stand-in thresholds (price, year, area) in the units of the binding.
THRESH = {"sale_price": (1000.0, 100000.0), "year_built": (1800, 2026), "gross_sqft": (2.0, 49.0)}


@register("threshold_report", with_sales("""
SELECT "column", violations FROM (
  SELECT count(*) FILTER (WHERE NOT (sale_price BETWEEN 1000.0 AND 100000.0)) AS sale_price,
         count(*) FILTER (WHERE NOT (year_built BETWEEN 1800 AND 2026)) AS year_built,
         count(*) FILTER (WHERE NOT (gross_sqft BETWEEN 2.0 AND 49.0)) AS gross_sqft FROM raw)
UNPIVOT (violations FOR "column" IN (sale_price, year_built, gross_sqft))""", RAW_SQL))
def threshold_report(spark, d):
    from lotmarket.operators.quality import threshold_violations
    return finish(threshold_violations(raw_frame(spark, d), THRESH))


AUDIT_COLS = ["building_type", "gross_sqft", "land_sqft", "apartment", "easement"]


PIPE_B_ORDER = ["sale_price", "address", "neighborhood", "sale_date", "total_units", "year_built",
                "building_type", "gross_sqft", "land_sqft", "borough_name", "apartment"]
PIPE_B_FILL = {"gross_sqft": 1.0, "land_sqft": 0.0, "building_type": "UNKNOWN"}
PIPE_B_UPPER = ["borough_name", "neighborhood"]


def _flagged(df):
    return df.withColumns({"is_internal_transfer": cl.flag_below("sale_price", 1000), "is_luxury": cl.flag_above("sale_price", 100000)})


# Which columns are left after drop_sparse depends on the data: the steps behind it take those that are there.
PIPE_B = [
    ("dedup_full", rel.dedup_full),
    ("dedup_key", lambda df: rel.dedup_first(df, ["l_orderkey", "l_linenumber"], PIPE_B_ORDER)),
    ("drop_sparse", cl.drop_sparse_seen(50.0)),  # C5: apartment (2/3 missing) and easement (all missing)
    ("fill", lambda df: cl.impute_const(df, {c: v for c, v in PIPE_B_FILL.items() if c in df.columns})),
    ("types", lambda df: df.withColumns({c: F.col(c).try_cast("int") for c in ["year_built"] if c in df.columns})),
    ("text", lambda df: cl.trim_text_columns(df).withColumns({c: F.upper(c) for c in PIPE_B_UPPER if c in df.columns})),
    ("flags", lambda df: _flagged(df) if "sale_price" in df.columns else df),
]

# The audit in SQL: each step's rows, the NULLs of each column of them in long form (state k is what step k leaves), and
# the columns that are too sparse after dedup_key left out of the states behind it.
RAW_COLS = ["l_orderkey", "l_linenumber", "borough_name", "neighborhood", "building_type", "address", "sale_price", "gross_sqft",
            "land_sqft", "total_units", "year_built", "sale_date", "apartment", "easement"]
FLAG_COLS = ["is_internal_transfer", "is_luxury"]


def _state_sql(k: int, rows: str, columns: list[str]) -> str:
    counts = ", ".join(f"count(*) - count({c}) AS {c}" for c in columns)
    return (f"SELECT {k} AS k, n_rows, \"column\", nulls FROM (SELECT count(*) AS n_rows, {counts} FROM {rows}) "
            f"UNPIVOT (nulls FOR \"column\" IN ({', '.join(columns)}))")


AUDIT_CTES = RAW_SQL + f""",
once AS (SELECT DISTINCT * FROM raw),
keyed AS MATERIALIZED (SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY {", ".join(f"{c} NULLS FIRST" for c in PIPE_B_ORDER)}) AS rk FROM once) WHERE rk = 1),
filled AS (SELECT * REPLACE (coalesce(gross_sqft, 1.0) AS gross_sqft, coalesce(land_sqft, 0.0) AS land_sqft,
                             coalesce(building_type, 'UNKNOWN') AS building_type) FROM keyed),
typed AS (SELECT * REPLACE (TRY_CAST(year_built AS INTEGER) AS year_built) FROM filled),
texts AS (SELECT * REPLACE (upper(trim(borough_name)) AS borough_name, upper(trim(neighborhood)) AS neighborhood,
                            trim(building_type) AS building_type, trim(address) AS address, trim(apartment) AS apartment,
                            trim(easement) AS easement) FROM typed),
flagged AS (SELECT *, sale_price < 1000 AS is_internal_transfer, sale_price > 100000 AS is_luxury FROM texts),
counted AS MATERIALIZED (
  {_state_sql(0, "raw", RAW_COLS)}
  UNION ALL {_state_sql(1, "once", RAW_COLS)}
  UNION ALL {_state_sql(2, "keyed", RAW_COLS)}
  UNION ALL {_state_sql(3, "keyed", RAW_COLS)}
  UNION ALL {_state_sql(4, "filled", RAW_COLS)}
  UNION ALL {_state_sql(5, "typed", RAW_COLS)}
  UNION ALL {_state_sql(6, "texts", RAW_COLS)}
  UNION ALL {_state_sql(7, "flagged", RAW_COLS + FLAG_COLS)}),
sparse AS (SELECT "column" FROM counted WHERE k = 2 AND n_rows > 0 AND nulls * 100.0 / n_rows > 50),
state AS MATERIALIZED (
  SELECT * FROM counted
  WHERE k < 3 OR CASE WHEN "column" IN ('is_internal_transfer', 'is_luxury') THEN 'sale_price' ELSE "column" END
                 NOT IN (SELECT "column" FROM sparse)),
total AS (SELECT k, any_value(n_rows) AS n_rows FROM counted GROUP BY k),
width AS (SELECT k, count(*) AS n_columns FROM state GROUP BY k),
steps AS (SELECT * FROM (VALUES (1, 'dedup_full'), (2, 'dedup_key'), (3, 'drop_sparse'), (4, 'fill'), (5, 'types'), (6, 'text'),
                                (7, 'flags')) AS v(k, step))"""


@register("clean_audit", with_sales("""
SELECT step, 'rows' AS metric, CAST(NULL AS VARCHAR) AS "column", b.n_rows AS before, a.n_rows AS after
FROM steps s JOIN total b ON b.k = s.k - 1 JOIN total a ON a.k = s.k
UNION ALL
SELECT step, 'columns', NULL, b.n_columns, a.n_columns FROM steps s JOIN width b ON b.k = s.k - 1 JOIN width a ON a.k = s.k
UNION ALL
SELECT step, 'nulls', "column", max(nulls) FILTER (WHERE x.k = s.k - 1), max(nulls) FILTER (WHERE x.k = s.k)
FROM steps s JOIN state x ON x.k IN (s.k - 1, s.k) GROUP BY "column", step
""", AUDIT_CTES))
def clean_audit(spark, d):
    _, trail = cl.audited(raw_frame(spark, d, by_order=True), PIPE_B)
    return finish(trail)


@register("clean_audit_nulls", with_sales("""
SELECT 'fill' AS step, 'nulls' AS metric, "column", before, after FROM (
  SELECT 'building_type' AS "column", count(*) - count(building_type) AS before, CAST(0 AS BIGINT) AS after FROM d
  UNION ALL SELECT 'gross_sqft', count(*) - count(gross_sqft), 0 FROM d
  UNION ALL SELECT 'land_sqft', count(*) - count(land_sqft), 0 FROM d)""",
                                             RAW_SQL + """,
d AS (SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY sale_price, address, neighborhood, sale_date, total_units, year_built, building_type,
                 gross_sqft, land_sqft, borough_name, apartment) AS rk FROM (SELECT DISTINCT * FROM raw)) WHERE rk = 1)"""))
def clean_audit_nulls(spark, d):
    _, trail = cl.audited(raw_frame(spark, d, by_order=True), PIPE_B, AUDIT_COLS)
    return finish(trail.where((F.col("metric") == "nulls") & (F.col("step") == "fill")
                              & F.col("before").isNotNull() & F.col("after").isNotNull()))


# The columns of pipeline A by kind; NULLs of every numeric one become its median, of every text one its mode.
PIPE_NUM = ["boro_income", "sale_price", "gross_sqft", "land_sqft", "total_units", "year_built"]
PIPE_TEXT = ["borough_name", "neighborhood", "building_type", "address", "apartment"]
PIPE_CLIP = ["sale_price", "gross_sqft", "land_sqft"]
_MEDIAN = ", ".join(f"CAST(coalesce({c}, (SELECT median({c}) FROM e)) AS DOUBLE) AS {c}" for c in PIPE_NUM if c != "year_built")
_MODE = ", ".join(f"coalesce({c}, (SELECT {c} FROM e WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}" for c in PIPE_TEXT)
_QUART = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_1, quantile_cont({c}, 0.75) AS {c}_3" for c in PIPE_CLIP)
_CLIPPED = ", ".join(f"least(greatest({c}, {c}_1 - 1.5 * ({c}_3 - {c}_1)), {c}_3 + 1.5 * ({c}_3 - {c}_1)) AS {c}" for c in PIPE_CLIP)
PIPE_A_CTES = IND_CTES + ",\n" + RAW_SQL + f""",
e AS (SELECT DISTINCT r.* EXCLUDE (easement), iw.boro_income FROM raw r LEFT JOIN iw ON r.borough_name = iw.region),
f AS (SELECT l_orderkey, l_linenumber, sale_date, {_MEDIAN}, coalesce(year_built, (SELECT median(year_built) FROM e)) AS year_built, {_MODE} FROM e),
q AS (SELECT {_QUART} FROM f),
g AS (SELECT f.* EXCLUDE ({", ".join(PIPE_CLIP)}), {_CLIPPED} FROM f, q)"""


@register("clean_pipeline_a", with_sales("""
SELECT l_orderkey, l_linenumber, borough_name, neighborhood, building_type, address, apartment, round(boro_income, 4) AS boro_income,
       round(sale_price, 4) AS sale_price, round(gross_sqft, 4) AS gross_sqft, round(land_sqft, 4) AS land_sqft,
       round(total_units, 4) AS total_units, round(CASE WHEN gross_sqft > 0 THEN sale_price / gross_sqft END, 4) AS price_per_sqft,
       CAST(starts_with(building_type, 'S') AS INTEGER)::BIGINT AS is_residential,
       CAST(greatest(least(year(sale_date) - year_built, 200), 0) AS BIGINT) AS building_age,
       CAST(year(sale_date) AS BIGINT) AS sale_year, CAST(month(sale_date) AS BIGINT) AS sale_month
FROM g""", PIPE_A_CTES))
def clean_pipeline_a(spark, d):
    """Whole-row duplicates go, NULLs become the column's median (numbers) or mode (text), three columns are
    clamped to their quartile fences, derived columns follow.  The enriched rows are written once, as every step
    reads them again."""
    raw = raw_frame(spark, d, by_order=True).drop("easement")
    iw = indicators_wide(spark, d).select(F.col("region").alias("borough_name"), "boro_income")
    e = rel.dedup_full(raw.join(iw, "borough_name", "left"))
    e = materialize(e.withColumn("total_units", F.col("total_units").cast("double")).withColumn("year_built", F.col("year_built").cast("double")), "clean-rows")
    f = cl.impute_mode(cl.impute_median(e, PIPE_NUM), PIPE_TEXT)
    c = cl.iqr_clip(f, PIPE_CLIP)
    out = c.select("l_orderkey", "l_linenumber", *PIPE_TEXT, "boro_income", *PIPE_CLIP, "total_units",
                   fx.guarded_ratio("sale_price", "gross_sqft").alias("price_per_sqft"),
                   cl.prefix_flag("building_type", "S").alias("is_residential"),
                   fx.clip(F.year("sale_date") - F.col("year_built"), 0, 200).cast("bigint").alias("building_age"),
                   F.year("sale_date").alias("sale_year"), F.month("sale_date").alias("sale_month"))
    return finish(out)


@register("clean_pipeline_b", with_sales("""
SELECT l_orderkey, l_linenumber, upper(trim(borough_name)) AS borough, upper(trim(neighborhood)) AS neighborhood,
       coalesce(building_type, 'UNKNOWN') AS building_type, round(sale_price, 4) AS sale_price,
       round(coalesce(gross_sqft, 1.0), 4) AS gross_sqft, round(coalesce(land_sqft, 0.0), 4) AS land_sqft,
       CAST(year_built AS INTEGER)::BIGINT AS year_built, sale_price < 1000 AS is_internal_transfer,
       sale_price > 100000 AS is_luxury
FROM d""", RAW_SQL + """,
d AS (SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY sale_price, address, neighborhood, sale_date, total_units, year_built, building_type,
                 gross_sqft, land_sqft, borough_name, apartment) AS rk FROM (SELECT DISTINCT * FROM raw)) WHERE rk = 1)"""))
def clean_pipeline_b(spark, d):
    cleaned, _ = cl.audited(raw_frame(spark, d, by_order=True), PIPE_B, AUDIT_COLS)
    return finish(cleaned.select("l_orderkey", "l_linenumber", F.col("borough_name").alias("borough"), "neighborhood", "building_type",
                                 "sale_price", "gross_sqft", "land_sqft", "year_built", *FLAG_COLS))


SUFFIXES = ["HEIGHTS", "VILLAGE", "AREA", "DISTRICT"]


@register("ingest_pipeline", with_sales("""
SELECT l_orderkey, l_linenumber, regexp_replace(upper(trim(neighborhood || ' AREA')), '\\s+(HEIGHTS|VILLAGE|AREA|DISTRICT)$', '') AS neighborhood,
       upper(borough_name) AS borough, round(sale_price, 4) AS sale_price, round(gross_sqft, 4) AS gross_sqft,
       round(iw.boro_income, 4) AS boro_income
FROM (SELECT * EXCLUDE (rk) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                     ORDER BY sale_price, address, sale_date, gross_sqft, neighborhood, borough_name) AS rk
        FROM raw WHERE NOT (sale_price IS NULL AND gross_sqft IS NULL AND land_sqft IS NULL)
          AND sale_price BETWEEN 1000.0 AND 100000.0 AND gross_sqft BETWEEN 2.0 AND 49.0) WHERE rk = 1) r
LEFT JOIN iw ON r.borough_name = iw.region""", IND_CTES + ",\n" + RAW_SQL))
def ingest_pipeline(spark, d):
    raw = raw_frame(spark, d)
    x = cl.threshold_clean(raw.select("l_orderkey", "l_linenumber", "neighborhood", "borough_name", "sale_price",
                                      "gross_sqft", "land_sqft", "address", "sale_date"),
                           {"sale_price": (1000.0, 100000.0), "gross_sqft": (2.0, 49.0)})
    x = x.withColumn("sale_price", fx.coerce_numeric("sale_price"))
    iw = indicators_wide(spark, d).select(F.col("region").alias("borough_name"), "boro_income")
    std = x.select("l_orderkey", "l_linenumber", "borough_name", "sale_price", "gross_sqft", "address", "sale_date",
                   fx.strip_suffix(F.upper(F.trim(F.concat("neighborhood", F.lit(" AREA")))), SUFFIXES)
                   .alias("neighborhood"))
    dd = rel.dedup_first(std, ["l_orderkey", "l_linenumber"],
                         ["sale_price", "address", "sale_date", "gross_sqft", "neighborhood", "borough_name"])
    out = dd.join(iw, "borough_name", "left").select(
        "l_orderkey", "l_linenumber", "neighborhood", F.upper("borough_name").alias("borough"), "sale_price",
        "gross_sqft", "boro_income")
    return finish(out)
