"""Stand-in sales star schema over the driver tables.

The operators are generic over column names; this module binds them to the
TPC-H-like test tables (SURVEY 7.1):

=========================  =======================================
reference concept          stand-in
=========================  =======================================
sale                       ``lineitem`` row
sale_price                 ``l_extendedprice``
gross_sqft / land_sqft     ``l_quantity`` / ``p_retailprice``
sale_date                  ``l_shipdate`` as DATE
year_built                 year of ``o_orderdate``
building_type / category   ``p_type`` (6) / ``p_brand`` (25)
total_units                ``p_size``
address                    ``p_name``
neighborhood / borough     ``nation`` / ``region`` via orders -> customer
=========================  =======================================

Each stand-in exists twice: as a lazy Spark DataFrame and as the equivalent
DuckDB SQL text the oracle runs.  Both must stay column-for-column equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmarket.sources.files import bucketed

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Price scale of the stand-in data is 900..105,000, so the reference's $1M
# thresholds map to these (fixed values of the binding, not of the operators).
HIGH_PRICE = 50_000.0
PRICE_FLOOR = 10_000.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region: 25 rows by the schema's definition, safe to broadcast."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
            .select(F.col("n_nationkey"),
                    F.col("r_regionkey").cast("bigint").alias("borough"),
                    F.col("r_name").alias("borough_name"),
                    F.col("n_nationkey").cast("bigint").alias("neighborhood_id"),
                    F.col("n_name").alias("neighborhood")))


PART_COLUMNS = ("building_type", "building_category", "address", "land_sqft", "total_units")


def sales(spark: SparkSession, sf_dir: str, part: bool = True) -> DataFrame:
    """The denormalised sales frame (star join J1), lazily.

    Join order for scale: customer meets nation x region first (25 rows,
    broadcast), orders meet that customer table on ``custkey`` (the order-sized
    side is shuffled once), and only then the fact-sized lineitem meets the
    enriched orders on ``orderkey``; part joins last.  With ``part=False`` the
    part join is left out for queries that read none of its columns (part keys
    of lineitem all exist, so the rows are the same) and the fact is shuffled
    once less.  AQE broadcasts any side whose runtime size is under its
    threshold; columns a query does not use are pruned at the parquet scans.
    """
    li = table(spark, sf_dir, "lineitem")
    orders = placed_orders(spark, sf_dir)
    j = li.join(orders, li.l_orderkey == orders.o_orderkey)
    if part:
        p = table(spark, sf_dir, "part")
        j = j.join(p, li.l_partkey == p.p_partkey)
    return sales_columns(j, part)


#: Fact rows of a task where the star is dealt by order.
ROWS_PER_TASK = 200_000


def sales_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales frame dealt by order key, in as many parts as the fact's rows ask for: a task's sorts and hash tables
    stay as large as ``ROWS_PER_TASK`` rows make them, however few shuffle partitions the session has.  What groups by
    that key (and others) afterwards moves no rows."""
    li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    n = max(2, -(-li.count() // ROWS_PER_TASK))
    fact = li.join(p, li.l_partkey == p.p_partkey).select(*FACT_COLUMNS).repartition(n, "l_orderkey")
    orders = placed_orders(spark, sf_dir).select(*ORDER_COLUMNS).repartition(n, "o_orderkey")
    return laid_out_sales(fact, orders)


def placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer, nation and region."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    cust = c.join(F.broadcast(geo(spark, sf_dir)), c.c_nationkey == F.col("n_nationkey"))
    return o.join(cust, o.o_custkey == cust.c_custkey)


def sales_columns(j: DataFrame, part: bool = True) -> DataFrame:
    """The joined tables' columns under the names of the sales frame."""
    ship = F.col("l_shipdate").cast("date")
    part_cols = []
    if part:
        part_cols = [F.col("p_type").alias("building_type"), F.col("p_brand").alias("building_category"),
                     F.col("p_name").alias("address"), F.col("p_retailprice").alias("land_sqft"),
                     F.col("p_size").cast("bigint").alias("total_units")]
    return j.select(
        F.col("l_orderkey"), F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        F.col("l_partkey"), F.col("l_suppkey"), F.col("c_custkey"),
        "borough", "borough_name", "neighborhood_id", "neighborhood", *part_cols,
        F.col("c_mktsegment").alias("segment"),
        F.col("l_extendedprice").alias("sale_price"), F.col("l_quantity").alias("gross_sqft"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
        F.col("l_returnflag").alias("flag"),
        ship.alias("sale_date"),
        F.year(ship).cast("bigint").alias("sale_year"),
        F.month(ship).cast("bigint").alias("sale_month"),
        F.year(F.col("o_orderdate")).cast("bigint").alias("year_built"),
        F.datediff(ship, F.col("o_orderdate").cast("date")).cast("bigint").alias("age_days"),
        F.col("c_acctbal").alias("buyer_income"),
    )


#: Columns of the laid-out tables: what the sales frame reads.
FACT_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
                "l_returnflag", "l_shipdate", "p_type", "p_brand", "p_name", "p_retailprice", "p_size")
ORDER_COLUMNS = ("o_orderkey", "o_orderdate", "o_totalprice", "c_custkey", "c_mktsegment", "c_acctbal", "borough", "borough_name",
                 "neighborhood_id", "neighborhood")


def star_layout(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The star, laid out once for many queries: the fact with its part, and orders with customer and place, both
    bucketed by order key.  Whatever joins or groups them by that key afterwards moves no rows."""
    li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    fact = li.join(p, li.l_partkey == p.p_partkey).select(*FACT_COLUMNS)
    orders = placed_orders(spark, sf_dir).select(*ORDER_COLUMNS)
    return bucketed(fact, ["l_orderkey"], "fact-by-order", buckets), bucketed(orders, ["o_orderkey"], "orders-by-order", buckets)


def laid_out_sales(fact: DataFrame, orders: DataFrame) -> DataFrame:
    """The sales frame from the tables of ``star_layout``; the fact stays where it lies."""
    return sales_columns(fact.join(orders, F.col("l_orderkey") == F.col("o_orderkey")))


SALES_SQL = """
SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_partkey, l.l_suppkey, c.c_custkey,
       CAST(r.r_regionkey AS BIGINT) AS borough, r.r_name AS borough_name,
       CAST(n.n_nationkey AS BIGINT) AS neighborhood_id, n.n_name AS neighborhood,
       p.p_type AS building_type, p.p_brand AS building_category, p.p_name AS address,
       c.c_mktsegment AS segment,
       l.l_extendedprice AS sale_price, l.l_quantity AS gross_sqft, p.p_retailprice AS land_sqft,
       CAST(p.p_size AS BIGINT) AS total_units, l.l_discount AS discount, l.l_tax AS tax,
       l.l_returnflag AS flag,
       CAST(l.l_shipdate AS DATE) AS sale_date,
       CAST(year(l.l_shipdate) AS BIGINT) AS sale_year,
       CAST(month(l.l_shipdate) AS BIGINT) AS sale_month,
       CAST(year(o.o_orderdate) AS BIGINT) AS year_built,
       CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS BIGINT) AS age_days,
       c.c_acctbal AS buyer_income
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey
"""


def with_sales(body: str, extra_ctes: str = "") -> str:
    """Prefix an oracle query with the ``sales`` CTE (plus optional more CTEs)."""
    more = f",\n{extra_ctes}" if extra_ctes else ""
    return f"WITH sales AS ({SALES_SQL}){more}\n{body}"


# --------------------------------------------------------------------------- region indicators

def region_indicators_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long indicator table ``(region, indicator, value)`` derived from the tables.

    Stand-ins for the reference's borough indicators (income, counts of
    amenities, population, price level ...), each an aggregate of a driver
    table per region so the work grows with the data.
    """
    g = geo(spark, sf_dir)
    c = table(spark, sf_dir, "customer")
    s = table(spark, sf_dir, "supplier")
    o = table(spark, sf_dir, "orders")
    cust = c.join(F.broadcast(g), c.c_nationkey == F.col("n_nationkey"))
    cust_stats = cust.groupBy("borough_name").agg(
        F.count("*").cast("double").alias("population"),
        F.avg("c_acctbal").alias("boro_income"),
        (F.avg(F.when(F.col("c_acctbal") < 0, 1.0).otherwise(0.0)) * 100).alias("poverty_pct"),
        (F.avg(F.when(F.col("c_mktsegment") == "BUILDING", 1.0).otherwise(0.0)) * 100).alias("bachelor_pct"))
    supp = s.join(F.broadcast(g), s.s_nationkey == F.col("n_nationkey"))
    supp_stats = supp.groupBy("borough_name").agg(
        F.count("*").cast("double").alias("parks_count"),
        F.avg("s_acctbal").alias("walk_score_raw"))
    ords = o.join(c.select("c_custkey", "c_nationkey"), o.o_custkey == c.c_custkey) \
        .join(F.broadcast(g), F.col("c_nationkey") == F.col("n_nationkey"))
    ord_stats = ords.groupBy("borough_name").agg(
        (F.avg(F.when(F.col("o_orderpriority") == "1-URGENT", 1.0).otherwise(0.0)) * 100).alias("crime_pct"),
        (F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)) * 100).alias("school_pct"))
    wide = cust_stats.join(supp_stats, "borough_name", "full").join(ord_stats, "borough_name", "full")
    names = [c_ for c_ in wide.columns if c_ != "borough_name"]
    return wide.unpivot("borough_name", names, "indicator", "value") \
        .withColumnRenamed("borough_name", "region")


REGION_INDICATORS_SQL = """
region_indicators AS (
  SELECT region, indicator, value FROM (
    SELECT g.borough_name AS region,
           CAST(count(*) AS DOUBLE) AS population,
           avg(c.c_acctbal) AS boro_income,
           avg(CASE WHEN c.c_acctbal < 0 THEN 1.0 ELSE 0.0 END) * 100 AS poverty_pct,
           avg(CASE WHEN c.c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END) * 100 AS bachelor_pct
    FROM customer c JOIN geo g ON c.c_nationkey = g.n_nationkey GROUP BY g.borough_name
  ) UNPIVOT (value FOR indicator IN (population, boro_income, poverty_pct, bachelor_pct))
  UNION ALL
  SELECT region, indicator, value FROM (
    SELECT g.borough_name AS region, CAST(count(*) AS DOUBLE) AS parks_count,
           avg(s.s_acctbal) AS walk_score_raw
    FROM supplier s JOIN geo g ON s.s_nationkey = g.n_nationkey GROUP BY g.borough_name
  ) UNPIVOT (value FOR indicator IN (parks_count, walk_score_raw))
  UNION ALL
  SELECT region, indicator, value FROM (
    SELECT g.borough_name AS region,
           avg(CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END) * 100 AS crime_pct,
           avg(CASE WHEN o.o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) * 100 AS school_pct
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN geo g ON c.c_nationkey = g.n_nationkey GROUP BY g.borough_name
  ) UNPIVOT (value FOR indicator IN (crime_pct, school_pct))
)"""

GEO_SQL = """
geo AS (
  SELECT n.n_nationkey, CAST(r.r_regionkey AS BIGINT) AS borough, r.r_name AS borough_name,
         CAST(n.n_nationkey AS BIGINT) AS neighborhood_id, n.n_name AS neighborhood
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""
