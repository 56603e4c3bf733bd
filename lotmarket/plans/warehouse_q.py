"""Warehouse build and reconciliation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotmarket.operators import quality as qa
from lotmarket.operators import relational as rel
from lotmarket.operators import warehouse as wh
from lotmarket.plans.binding import sales, sales_by_order, table, with_sales
from lotmarket.plans.catalog import register
from lotmarket.plans.common import finish
from lotmarket.sources.files import materialize

LOC_KEYS = ["neighborhood", "address"]
PROP_KEYS = ["building_type", "building_category", "total_units"]

DIMS_SQL = """loc AS (SELECT neighborhood, address, row_number() OVER (ORDER BY neighborhood, address) AS location_id
                FROM (SELECT DISTINCT neighborhood, address FROM sales)),
prop AS (SELECT building_type, building_category, total_units,
                row_number() OVER (ORDER BY building_type, building_category, total_units) AS property_id
         FROM (SELECT DISTINCT building_type, building_category, total_units FROM sales)),
soc AS (SELECT borough_name, row_number() OVER (ORDER BY borough_name) AS social_id
        FROM (SELECT DISTINCT borough_name FROM sales)),
fact AS (SELECT s.l_orderkey, s.l_linenumber, coalesce(loc.location_id, 1) AS location_id,
                coalesce(prop.property_id, 1) AS property_id, coalesce(soc.social_id, 1) AS social_id,
                s.sale_price, CASE WHEN s.gross_sqft > 0 THEN s.sale_price / s.gross_sqft END AS price_per_sqft,
                strftime(s.sale_date, '%Y-%m-%d') AS sale_date, s.sale_year, s.sale_month
         FROM sales s LEFT JOIN loc USING (neighborhood, address)
         LEFT JOIN prop USING (building_type, building_category, total_units)
         LEFT JOIN soc USING (borough_name))"""


FACT_COLUMNS = ["l_orderkey", "l_linenumber", "neighborhood", "address", "building_type", "building_category", "total_units",
                "borough_name", "sale_price", "gross_sqft", "sale_date", "sale_year", "sale_month"]


def loc_dim(s):
    return wh.distinct_dimension(s, LOC_KEYS, "location_id")


def prop_dim(s):
    return wh.distinct_dimension(s, PROP_KEYS, "property_id", extra={"year_built": "bigint"})


def soc_dim(s):
    return wh.distinct_dimension(s, ["borough_name"], "social_id")


def sale_rows(spark, d):
    """The star join's columns that the fact and its dimensions are made of, written once for all of them."""
    return materialize(sales(spark, d).select(*FACT_COLUMNS), "sale-rows")


def build_fact(s, loc, prop, soc):
    s = s.withColumn("sale_date", F.coalesce(F.date_format(F.col("sale_date").try_cast("date"), "yyyy-MM-dd"), F.col("sale_date").cast("string")))
    s = wh.coerce_measures(s, numbers=["sale_price"], ints=["sale_year", "sale_month"], texts=["sale_date"], names=["borough_name"])
    f = wh.attach_key(s, loc, LOC_KEYS, "location_id", 1)
    f = wh.attach_key(f, prop, PROP_KEYS, "property_id", 1)
    f = wh.attach_key(f, soc, ["borough_name"], "social_id", 1)
    return f.select("l_orderkey", "l_linenumber", "location_id", "property_id", "social_id", "sale_price",
                    F.try_divide(F.col("sale_price"), F.when(F.col("gross_sqft") > 0, F.col("gross_sqft")))
                    .alias("price_per_sqft"),
                    "sale_date", "sale_year", "sale_month")


def fact_of(spark, d):
    s = sale_rows(spark, d)
    return build_fact(s, loc_dim(s), prop_dim(s), soc_dim(s))


@register("surrogate_keys", with_sales("SELECT * FROM loc", DIMS_SQL))
def surrogate_keys(spark, d):
    return finish(loc_dim(sales(spark, d, part=True)))


@register("property_dim", with_sales("SELECT *, CAST(NULL AS BIGINT) AS year_built FROM prop", DIMS_SQL))
def property_dim(spark, d):
    return finish(prop_dim(sales(spark, d)))


@register("fact_build", with_sales("SELECT * EXCLUDE (sale_price, price_per_sqft), round(sale_price, 4) AS sale_price, "
                                   "round(price_per_sqft, 4) AS price_per_sqft FROM fact", DIMS_SQL))
def fact_build(spark, d):
    return finish(fact_of(spark, d))


# Sales as a text file brings them: padded names, missing or unreadable prices, years and dates.
@register("fact_coerced", with_sales("""
SELECT s.l_orderkey, s.l_linenumber, coalesce(loc.location_id, 1) AS location_id, coalesce(prop.property_id, 1) AS property_id,
       coalesce(soc.social_id, 1) AS social_id, CASE WHEN s.l_linenumber % 3 <> 0 THEN round(s.sale_price, 4) END AS sale_price,
       CASE WHEN s.l_linenumber % 3 <> 0 AND s.gross_sqft > 0 THEN round(s.sale_price / s.gross_sqft, 4) END AS price_per_sqft,
       CASE s.l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN 'sold on ' || strftime(s.sale_date, '%Y-%m-%d') || ' a'
                               ELSE strftime(s.sale_date, '%Y-%m-%d') END AS sale_date,
       CASE WHEN s.l_linenumber % 4 IN (0, 1) THEN s.sale_year ELSE 0 END AS sale_year,
       CASE WHEN s.l_linenumber % 5 = 0 THEN 0 ELSE s.sale_month END AS sale_month
FROM sales s LEFT JOIN loc USING (neighborhood, address)
LEFT JOIN prop USING (building_type, building_category, total_units) LEFT JOIN soc USING (borough_name)""", DIMS_SQL))
def fact_coerced(spark, d):
    s = sale_rows(spark, d)
    n = F.col("l_linenumber")
    day = F.date_format("sale_date", "yyyy-MM-dd")
    raw = s.withColumns({
        "sale_price": F.when(n % 3 == 0, "unknown").otherwise(F.concat(F.lit(" "), F.col("sale_price").cast("string"))),
        "sale_date": F.when(n % 4 == 0, None).when(n % 4 == 1, F.concat(F.lit("  sold on "), day, F.lit(" at noon"))).otherwise(day),
        "sale_year": F.when(n % 4 == 0, F.col("sale_year").cast("string")).when(n % 4 == 1, F.concat(F.lit(" "), "sale_year", F.lit(".0 "))).when(n % 4 == 2, "n/a"),
        "sale_month": F.when(n % 5 == 0, "").otherwise(F.col("sale_month").cast("string")),
        "borough_name": F.concat(F.lit("  "), "borough_name", F.lit(" "))})
    return finish(build_fact(raw, loc_dim(s), prop_dim(s), soc_dim(s)))


def hash_id_sql(*keys: str, seed: int = 42) -> str:
    """DuckDB twin of :func:`lotmarket.operators.warehouse.hash_ids`."""
    h = f"md5(concat_ws('|', '{seed}', " + ", ".join(f"coalesce(CAST({k} AS VARCHAR), 'NULL')" for k in keys) + "))"
    return "CAST(" + " + ".join(f"(instr('0123456789abcdef', substring({h}, {i + 1}, 1)) - 1) * {16 ** (14 - i)}" for i in range(15)) + " AS BIGINT)"


@register("hash_keys", with_sales(f"SELECT neighborhood, address, {hash_id_sql(*LOC_KEYS)} AS location_id FROM (SELECT DISTINCT neighborhood, address FROM sales)"))
def hash_keys(spark, d):
    """Ids of the location dimension from its key alone (no window, no sort)."""
    s = sales(spark, d)
    return finish(wh.hash_ids(s.select(*LOC_KEYS).distinct(), LOC_KEYS, "location_id"))


@register("row_dimensions", with_sales(f"""
SELECT l_orderkey, l_linenumber, {hash_id_sql('l_orderkey', 'l_linenumber', 'neighborhood', 'address')} AS location_id,
       neighborhood, address, {hash_id_sql('l_orderkey', 'l_linenumber', 'building_type', 'building_category', 'total_units')} AS property_id,
       building_type, building_category, total_units, CAST(NULL AS BIGINT) AS year_built FROM sales"""))
def row_dimensions(spark, d):
    """K3/K4: location and property dimensions with a row per sale; their ids come from the row's key and values, so
    the fact computes the same ids by itself and needs no join to them."""
    s = sales(spark, d).select("l_orderkey", "l_linenumber", *LOC_KEYS, *PROP_KEYS)
    row = ["l_orderkey", "l_linenumber"]
    out = wh.hash_ids(wh.hash_ids(s, [*row, *LOC_KEYS], "location_id"), [*row, *PROP_KEYS], "property_id")
    return finish(out.withColumn("year_built", F.lit(None).cast("bigint")))


@register("dim_first_per_key", """
SELECT CAST(s_nationkey AS BIGINT) AS s_nationkey, s_suppkey, s_name, round(s_acctbal, 4) AS s_acctbal FROM (
  SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rk FROM supplier) WHERE rk = 1""")
def dim_first_per_key(spark, d):
    s = table(spark, d, "supplier").select("s_nationkey", "s_suppkey", "s_name", "s_acctbal")
    return finish(rel.dedup_first(s, "s_nationkey", ["s_suppkey"]))


@register("reconcile_counts", with_sales("""
SELECT (SELECT count(*) FROM lineitem) AS source_rows, (SELECT count(*) FROM fact) AS target_rows,
       (SELECT count(*) FROM lineitem) = (SELECT count(*) FROM fact) AS ok""", DIMS_SQL))
def reconcile_counts(spark, d):
    return finish(qa.reconcile_counts(table(spark, d, "lineitem"), fact_of(spark, d)))


@register("reconcile_sum", with_sales("""
SELECT round(a, 4) AS source_sum, round(b, 4) AS target_sum, abs(a - b) <= 0.01 * abs(a) AS ok FROM
 (SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS a FROM lineitem),
 (SELECT CAST(sum(CAST(sale_price AS DECIMAL(18,2))) AS DOUBLE) AS b FROM fact)""", DIMS_SQL))
def reconcile_sum(spark, d):
    return finish(qa.reconcile_sum(table(spark, d, "lineitem"), "l_extendedprice", fact_of(spark, d), "sale_price"))


@register("check_summary", with_sales("""
SELECT count(*) AS checks, count(*) FILTER (WHERE ok) AS passed, count(*) FILTER (WHERE NOT ok) AS failed FROM (
  SELECT (SELECT count(*) FROM lineitem) = (SELECT count(*) FROM fact) AS ok
  UNION ALL SELECT abs(a - b) <= 0.01 * abs(a) FROM
    (SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS a FROM lineitem),
    (SELECT sum(CAST(sale_price AS DECIMAL(18,2))) AS b FROM fact)
  UNION ALL SELECT count(*) = 0 FROM fact f LEFT JOIN loc ON f.location_id = loc.location_id WHERE loc.location_id IS NULL
  UNION ALL SELECT count(*) = 0 FROM fact f LEFT JOIN prop ON f.property_id = prop.property_id WHERE prop.property_id IS NULL
  UNION ALL SELECT count(*) = 0 FROM fact f LEFT JOIN soc ON f.social_id = soc.social_id WHERE soc.social_id IS NULL)""",
                                         DIMS_SQL))
def check_summary(spark, d):
    s = sale_rows(spark, d)
    loc, prop, soc = loc_dim(s), prop_dim(s), soc_dim(s)
    fact = materialize(build_fact(s, loc, prop, soc), "fact")  # five checks read it
    li = table(spark, d, "lineitem")
    checks = [qa.reconcile_counts(li, fact).select(F.lit("counts").alias("check"), "ok"),
              qa.reconcile_sum(li, "l_extendedprice", fact, "sale_price").select(F.lit("sum").alias("check"), "ok")]
    for name, dim, key in (("loc", loc, "location_id"), ("prop", prop, "property_id"), ("soc", soc, "social_id")):
        o = rel.orphan_count(fact, key, dim, key)
        checks.append(o.select(F.lit(f"orphans_{name}").alias("check"), (F.col("orphans") == 0).alias("ok")))
    return finish(qa.check_summary(rel.union_sources(checks)))


@register("validation_report", with_sales("""
SELECT borough_name, total, invalid, total - invalid AS valid, total - d AS duplicates,
       concat_ws(';', CASE WHEN invalid > 0 THEN 'empty rows' END, CASE WHEN total - d > 0 THEN 'duplicate rows' END) AS issues
FROM (SELECT borough_name, count(*) AS total,
             count(*) FILTER (WHERE gp IS NULL AND ls IS NULL) AS invalid FROM v GROUP BY 1)
JOIN (SELECT borough_name, count(*) AS d FROM (SELECT DISTINCT borough_name, gp, ls, l_orderkey, l_linenumber FROM v) GROUP BY 1)
USING (borough_name)""", """v AS (SELECT borough_name, l_orderkey, l_linenumber,
  CASE WHEN discount = 0 THEN NULL ELSE gross_sqft END AS gp, CASE WHEN discount = 0 THEN NULL ELSE land_sqft END AS ls
  FROM sales)"""))
def validation_report(spark, d):
    s = sales_by_order(spark, d)
    v = s.select("borough_name", "l_orderkey", "l_linenumber",
                 F.when(F.col("discount") == 0, None).otherwise(F.col("gross_sqft")).alias("gp"),
                 F.when(F.col("discount") == 0, None).otherwise(F.col("land_sqft")).alias("ls"))
    return finish(qa.validation_report(v, "borough_name", ["gp", "ls"], ["gp", "ls", "l_orderkey", "l_linenumber"]))


TPC = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@register("table_counts", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in TPC))
def table_counts(spark, d):
    return finish(qa.table_counts({t: table(spark, d, t) for t in TPC}))
