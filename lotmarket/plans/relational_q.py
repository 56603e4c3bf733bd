"""Join, set-operation and de-duplication queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotmarket.functions import core as fx
from lotmarket.operators import market as mk
from lotmarket.operators import relational as rel
from lotmarket.operators.common import join_small
from lotmarket.operators.stats import group_quantiles, reread
from lotmarket.operators.warehouse import dense_ids
from lotmarket.plans.binding import (GEO_SQL, REGION_INDICATORS_SQL, geo, region_indicators_long, sales,
                                     table, with_sales)
from lotmarket.plans.catalog import register
from lotmarket.plans.common import finish

LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LI_SQL = ("l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, "
          "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS ship_date")


def lineitem_rows(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(*LI_COLS, F.col("l_shipdate").cast("date").alias("ship_date")) \
        .withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))


def with_repeats(spark, d):
    """lineitem plus a value-defined slice of itself (returned items): real duplicates."""
    rows = lineitem_rows(spark, d)
    return rows.unionByName(rows.where(F.col("l_returnflag") == "R"))


REPEATS_SQL = f"""rep AS (SELECT {LI_SQL} FROM lineitem UNION ALL
                      SELECT {LI_SQL} FROM lineitem WHERE l_returnflag = 'R')"""


@register("dedup_full", f"WITH {REPEATS_SQL} SELECT DISTINCT * FROM rep")
def dedup_full(spark, d):
    return finish(rel.dedup_full(with_repeats(spark, d)))


@register("dup_count", f"WITH {REPEATS_SQL} SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM rep)) AS duplicate_rows FROM rep")
def dup_count(spark, d):
    return finish(rel.dup_count(with_repeats(spark, d)))


DEDUP_ORDER = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus", "ship_date"]


@register("dedup_key", f"""
SELECT * EXCLUDE (rk) FROM (
  SELECT {LI_SQL}, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(DEDUP_ORDER)}) AS rk
  FROM lineitem) WHERE rk = 1""")
def dedup_key(spark, d):
    return finish(rel.dedup_first(lineitem_rows(spark, d), ["l_orderkey", "l_linenumber"], DEDUP_ORDER))


@register("dedup_removed_pct", """
SELECT count(*) AS before, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS after,
       round((count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))) * 100.0 / count(*), 4) AS removed_pct
FROM lineitem""")
def dedup_removed_pct(spark, d):
    rows = lineitem_rows(spark, d)
    after = rel.dedup_first(rows, ["l_orderkey", "l_linenumber"], DEDUP_ORDER)
    from lotmarket.operators.common import merge_rows
    b = rows.agg(F.count("*").alias("before"))
    a = after.agg(F.count("*").alias("after"))
    out = merge_rows(b, a).select("before", "after",
                                 ((F.col("before") - F.col("after")) * 100.0 / F.col("before")).alias("removed_pct"))
    return finish(out)


CUST_COLS = "c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment"


@register("insert_or_ignore", f"""
SELECT {CUST_COLS} FROM customer WHERE c_acctbal < 5000
UNION ALL
SELECT {CUST_COLS} FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
  AND c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 5000)""")
def insert_or_ignore(spark, d):
    c = table(spark, d, "customer")
    target = c.where(F.col("c_acctbal") < 5000)
    incoming = c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return finish(rel.insert_or_ignore(target, incoming, "c_custkey"))


@register("orphan_check", """
SELECT 'lineitem.orderkey' AS relation, count(*) AS orphans FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderkey IS NULL
UNION ALL
SELECT 'orders.custkey', count(*) FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey WHERE c.c_custkey IS NULL
UNION ALL
SELECT 'lineitem.partkey', count(*) FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey WHERE p.p_partkey IS NULL""")
def orphan_check(spark, d):
    li, o, c, p = (table(spark, d, t) for t in ("lineitem", "orders", "customer", "part"))
    parts = [("lineitem.orderkey", rel.orphan_count(li, "l_orderkey", o, "o_orderkey")),
             ("orders.custkey", rel.orphan_count(o, "o_custkey", c, "c_custkey")),
             ("lineitem.partkey", rel.orphan_count(li, "l_partkey", p, "p_partkey"))]
    out = None
    for name, f in parts:
        f = f.select(F.lit(name).alias("relation"), "orphans")
        out = f if out is None else out.unionByName(f)
    return finish(out)


def neighborhood_dim(spark, d, without=()):
    """K2: distinct (name, parent) with a dense surrogate id ordered by (parent, name)."""
    g = geo(spark, d).select(F.col("neighborhood").alias("neighborhood_name"), F.col("borough").alias("borough_id"))
    dist = g.where(~F.col("neighborhood_name").isin(*without)).distinct() if without else g.distinct()
    return dense_ids(dist, ["borough_id", "neighborhood_name"], "neighborhood_id")


@register("dim_distinct", with_sales("""
SELECT neighborhood_name, borough_id, dense_rank() OVER (ORDER BY borough_id, neighborhood_name) AS neighborhood_id
FROM (SELECT DISTINCT neighborhood AS neighborhood_name, borough AS borough_id FROM sales)"""))
def dim_distinct(spark, d):
    s = sales(spark, d).select(F.col("neighborhood").alias("neighborhood_name"), F.col("borough").alias("borough_id"))
    dist = rel.dedup_full(s)
    return finish(dense_ids(dist, ["borough_id", "neighborhood_name"], "neighborhood_id"))


@register("resolve_fk", with_sales("""
SELECT s.l_orderkey, s.l_linenumber, coalesce(dm.neighborhood_id, 1) AS neighborhood_id
FROM sales s LEFT JOIN dm ON s.neighborhood = dm.neighborhood_name AND s.borough = dm.borough_id""",
                                     """dm AS (SELECT neighborhood_name, borough_id,
  dense_rank() OVER (ORDER BY borough_id, neighborhood_name) AS neighborhood_id
  FROM (SELECT DISTINCT n.n_name AS neighborhood_name, CAST(n.n_regionkey AS BIGINT) AS borough_id FROM nation n
        WHERE n.n_name <> 'NATION_7'))"""))
def resolve_fk(spark, d):
    s = sales(spark, d, part=False).select("l_orderkey", "l_linenumber", "neighborhood", "borough")
    # one area is left out of the dimension so the default path is exercised
    dim = neighborhood_dim(spark, d, without=["NATION_7"])
    out = rel.resolve_fk(s, dim, {"neighborhood": "neighborhood_name", "borough": "borough_id"},
                         "neighborhood_id", 1)
    return finish(out.select("l_orderkey", "l_linenumber", "neighborhood_id"))


IND_WIDE_COLS = ["population", "boro_income", "parks_count", "crime_pct"]


def indicators_wide(spark, d):
    long = region_indicators_long(spark, d)
    return long.groupBy("region").agg(*[F.max(F.when(F.col("indicator") == c, F.col("value"))).alias(c)
                                        for c in IND_WIDE_COLS])


IND_WIDE_SQL = ("iw AS (SELECT region, " + ", ".join(
    f"max(value) FILTER (WHERE indicator = '{c}') AS {c}" for c in IND_WIDE_COLS)
    + " FROM region_indicators GROUP BY region)")
IND_CTES = GEO_SQL + "," + REGION_INDICATORS_SQL + ",\n" + IND_WIDE_SQL


@register("enrich_region", with_sales("""
SELECT s.l_orderkey, s.l_linenumber, s.borough_name, """ + ", ".join(f"round(iw.{c}, 4) AS {c}" for c in IND_WIDE_COLS)
                                        + " FROM sales s LEFT JOIN iw ON s.borough_name = iw.region", IND_CTES))
def enrich_region(spark, d):
    s = sales(spark, d, part=False).select("l_orderkey", "l_linenumber", "borough_name")
    iw = indicators_wide(spark, d).withColumnRenamed("region", "borough_name")
    return finish(join_small(s, iw, ["borough_name"]))


@register("target_encode", with_sales("""
SELECT l_orderkey, l_linenumber, neighborhood, round(sale_price, 4) AS sale_price,
       round(median(sale_price) OVER (PARTITION BY neighborhood), 4) AS neighborhood_median
FROM sales"""))
def target_encode(spark, d):
    s = sales(spark, d, part=False).select("l_orderkey", "l_linenumber", "neighborhood", "sale_price")
    s = reread(s)
    med = group_quantiles(s, "neighborhood", "sale_price", {"neighborhood_median": 0.5})
    # per-group statistic joined back (no window holding a whole group in one task)
    return finish(join_small(s, med, ["neighborhood"]))


@register("vs_group_median", with_sales("""
SELECT l_orderkey, l_linenumber, round((sale_price - m) / m * 100, 4) AS vs_median_pct
FROM (SELECT *, median(sale_price) OVER (PARTITION BY neighborhood, building_type) AS m FROM sales)"""))
def vs_group_median(spark, d):
    s = sales(spark, d).select("l_orderkey", "l_linenumber", "neighborhood", "building_type", "sale_price")
    s = reread(s)
    med = group_quantiles(s, ["neighborhood", "building_type"], "sale_price", {"m": 0.5})
    j = join_small(s, med, ["neighborhood", "building_type"])
    return finish(j.select("l_orderkey", "l_linenumber",
                           (F.try_divide(F.col("sale_price") - F.col("m"), F.col("m")) * 100).alias("vs_median_pct")))


@register("topn_semi", with_sales("""
SELECT building_category, count(*) AS n FROM sales WHERE building_category IN (
  SELECT building_category FROM sales GROUP BY 1 ORDER BY count(*) DESC, building_category LIMIT 6)
GROUP BY 1"""))
def topn_semi(spark, d):
    s = sales(spark, d)
    return finish(mk.count_by(rel.semi_top_n(s, "building_category", 6), "building_category"))


# Region bounding boxes (south, west, north, east).
BOXES = [("Manhattan", 40.6960, -74.0203, 40.8820, -73.9067),
         ("Bronx", 40.7850, -73.9332, 40.9176, -73.7654),
         ("Brooklyn", 40.5707, -74.0421, 40.7395, -73.8334),
         ("Queens", 40.5431, -73.9625, 40.8007, -73.7004),
         ("Staten Island", 40.4774, -74.2591, 40.6501, -74.0340)]

POINTS_SQL = """pts AS (
  SELECT c_custkey, c_mktsegment AS cls, 40.47 + (c_acctbal + 1000.0) / 11000.0 * 0.45 AS lat,
         -74.26 + ((c_custkey * 7919) % 1000) / 1000.0 * 0.56 AS lon FROM customer),
boxes AS (SELECT * FROM (VALUES """ + ", ".join(f"('{b[0]}', {b[1]}, {b[2]}, {b[3]}, {b[4]})" for b in BOXES) + """)
          t(name, south, west, north, east))"""


def poi_points(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", F.col("c_mktsegment").alias("cls"),
                    (F.lit(40.47) + (F.col("c_acctbal") + 1000.0) / 11000.0 * 0.45).alias("lat"),
                    (F.lit(-74.26) + ((F.col("c_custkey") * 7919) % 1000) / 1000.0 * 0.56).alias("lon"))




@register("bbox_join", f"""WITH {POINTS_SQL}
SELECT b.name, p.cls, count(*) AS n FROM pts p JOIN boxes b
  ON p.lat BETWEEN b.south AND b.north AND p.lon BETWEEN b.west AND b.east GROUP BY 1, 2""")
def bbox_join(spark, d):
    return finish(rel.range_join_count(poi_points(spark, d), BOXES, "lat", "lon", "cls"))


# A catchment box around each supplier of a positive balance: hundreds of overlapping boxes, larger with the balance.
CATCHMENTS_SQL = """catchments AS (
  SELECT s_suppkey, y - r AS south, x - 2 * r AS west, y + r AS north, x + 2 * r AS east FROM (
    SELECT s_suppkey, 40.47 + ((s_suppkey * 6151) % 997) / 997.0 * 0.45 AS y, -74.26 + ((s_suppkey * 7919) % 991) / 991.0 * 0.56 AS x,
           0.001 + s_acctbal / 10000.0 * 0.02 AS r FROM supplier WHERE s_acctbal > 0))"""


def catchments(spark, d):
    s = table(spark, d, "supplier").where("s_acctbal > 0")
    y = F.lit(40.47) + ((F.col("s_suppkey") * 6151) % 997) / 997.0 * 0.45
    x = F.lit(-74.26) + ((F.col("s_suppkey") * 7919) % 991) / 991.0 * 0.56
    r = F.lit(0.001) + F.col("s_acctbal") / 10000.0 * 0.02
    return s.select("s_suppkey", (y - r).alias("south"), (x - 2 * r).alias("west"), (y + r).alias("north"), (x + 2 * r).alias("east"))


@register("catchment_join", f"""WITH {POINTS_SQL}, {CATCHMENTS_SQL}
SELECT b.s_suppkey, p.cls, count(*) AS n FROM pts p JOIN catchments b
  ON p.lat BETWEEN b.south AND b.north AND p.lon BETWEEN b.west AND b.east GROUP BY 1, 2""")
def catchment_join(spark, d):
    """J8 over a table of boxes that comes from the data."""
    return finish(rel.range_join_count(poi_points(spark, d), catchments(spark, d), "lat", "lon", "cls", "s_suppkey"))


@register("rate_per_100k", f"""WITH {POINTS_SQL}
SELECT name, total, round(total * 100000.0 / (SELECT count(*) FROM customer), 4) AS rate_per_100k,
       building, machinery FROM (
  SELECT b.name, count(*) AS total, count(*) FILTER (WHERE p.cls = 'BUILDING') AS building,
         count(*) FILTER (WHERE p.cls = 'MACHINERY') AS machinery
  FROM pts p JOIN boxes b ON p.lat BETWEEN b.south AND b.north AND p.lon BETWEEN b.west AND b.east GROUP BY 1)""")
def rate_per_100k(spark, d):
    counts = rel.range_join_count(poi_points(spark, d), BOXES, "lat", "lon", "cls")
    wide = counts.groupBy("name").pivot("cls", ["BUILDING", "MACHINERY"]).agg(F.sum("n")) \
        .withColumnsRenamed({"BUILDING": "building", "MACHINERY": "machinery"})
    tot = counts.groupBy("name").agg(F.sum("n").alias("total"))
    from lotmarket.operators.common import attach
    pop = table(spark, d, "customer").agg(F.count("*").alias("_pop"))
    j = attach(tot.join(wide, "name"), pop)
    return finish(j.select("name", "total", fx.guarded_ratio(F.col("total") * 100000.0, "_pop").alias("rate_per_100k"),
                           F.coalesce("building", F.lit(0)).alias("building"),
                           F.coalesce("machinery", F.lit(0)).alias("machinery")))


@register("map_join_sum", """
WITH q AS (
  SELECT CAST(year(o.o_orderdate) AS BIGINT) AS year, lpad(CAST(c.c_nationkey AS VARCHAR), 3, '0') AS code,
         quarter(o.o_orderdate) AS qtr,
         CAST(o.o_orderpriority IN ('1-URGENT', '2-HIGH') AS BIGINT) AS felony,
         CAST(o.o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AS BIGINT) AS misdemeanour
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
files AS (SELECT year, code, qtr, sum(felony) AS felony, sum(misdemeanour) AS misdemeanour, count(*) AS total
          FROM q GROUP BY 1, 2, 3),
codes AS (SELECT lpad(CAST(n.n_nationkey AS VARCHAR), 3, '0') AS code, r.r_name AS region
          FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT region, year, CAST(sum(felony) AS BIGINT) AS felony, CAST(sum(misdemeanour) AS BIGINT) AS misdemeanour,
       CAST(sum(total) AS BIGINT) AS total
FROM files JOIN codes USING (code) GROUP BY 1, 2""")
def map_join_sum(spark, d):
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    coded = o.join(c.select("c_custkey", "c_nationkey"), o.o_custkey == c.c_custkey).select(
        F.year("o_orderdate").cast("bigint").alias("year"), F.quarter("o_orderdate").alias("qtr"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("code"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("bigint").alias("felony"))
    # one "file" per quarter, each aggregated by code, then unioned
    files = []
    for qn in (1, 2, 3, 4):
        f = coded.where(F.col("qtr") == qn).groupBy("year", "code").agg(
            F.sum("felony").alias("felony"), F.sum(1 - F.col("felony")).alias("misdemeanour"),
            F.count("*").alias("total"))
        files.append(f)
    allq = rel.union_sources(files)
    codes = geo(spark, d).select(F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("code"),
                                 F.col("borough_name").alias("region"))
    out = allq.join(F.broadcast(codes), "code").groupBy("region", "year").agg(
        F.sum("felony").alias("felony"), F.sum("misdemeanour").alias("misdemeanour"), F.sum("total").alias("total"))
    return finish(out)


@register("upsert_attributes", with_sales("""
SELECT iw.region, round(coalesce(u.parks_count, iw.parks_count), 4) AS parks_count,
       round(coalesce(u.boro_income, iw.boro_income), 4) AS boro_income,
       round(iw.population, 4) AS population, round(iw.crime_pct, 4) AS crime_pct
FROM iw LEFT JOIN (
  SELECT g.borough_name AS region, CAST(count(*) * 2 AS DOUBLE) AS parks_count, avg(s.s_acctbal) AS boro_income
  FROM supplier s JOIN geo g ON s.s_nationkey = g.n_nationkey
  WHERE g.borough_name IN ('ASIA', 'EUROPE') GROUP BY 1) u ON iw.region = u.region""", IND_CTES))
def upsert_attributes(spark, d):
    base = indicators_wide(spark, d)
    s = table(spark, d, "supplier").join(F.broadcast(geo(spark, d)), F.col("s_nationkey") == F.col("n_nationkey"))
    upd = s.where(F.col("borough_name").isin("ASIA", "EUROPE")).groupBy(F.col("borough_name").alias("region")) \
        .agg((F.count("*") * 2).cast("double").alias("parks_count"), F.avg("s_acctbal").alias("boro_income"))
    out = rel.upsert_attributes(base, upd, "region", ["parks_count", "boro_income"])
    return finish(out.select("region", "parks_count", "boro_income", "population", "crime_pct"))


@register("reconcile_groups", with_sales("""
SELECT coalesce(a.borough_name, b.borough_name) AS borough_name, round(a.v, 4) AS value_a, round(b.v, 4) AS value_b,
       round(a.v - b.v, 4) AS diff, coalesce(abs(a.v - b.v) < 1.0, false) AS ok
FROM (SELECT borough_name, avg(sale_price) AS v FROM sales GROUP BY 1) a
FULL JOIN (SELECT g.borough_name, sum(l.l_extendedprice) / count(*) AS v
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
           JOIN customer c ON o.o_custkey = c.c_custkey JOIN geo g ON c.c_nationkey = g.n_nationkey
           WHERE g.borough_name <> 'AFRICA' GROUP BY 1) b
  ON a.borough_name = b.borough_name""", GEO_SQL))
def reconcile_groups(spark, d):
    a = sales(spark, d, part=False).groupBy("borough_name").agg(F.avg("sale_price").alias("v"))
    li, o, c = (table(spark, d, t) for t in ("lineitem", "orders", "customer"))
    wh = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == F.col("c_custkey")) \
        .join(F.broadcast(geo(spark, d)), F.col("c_nationkey") == F.col("n_nationkey")) \
        .where(F.col("borough_name") != "AFRICA") \
        .groupBy("borough_name").agg((F.sum("l_extendedprice") / F.count("*")).alias("v"))
    return finish(rel.reconcile_groups(a, wh, "borough_name", "v", tol=1.0))


@register("row_fingerprint", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       substring(md5(concat_ws(chr(1), CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                                CAST(l_extendedprice AS VARCHAR), l_returnflag)), 1, 16) AS row_hash
FROM lineitem""")
def row_fingerprint(spark, d):
    li = table(spark, d, "lineitem")
    return finish(li.select("l_orderkey", "l_linenumber",
                            fx.fingerprint16("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
                            .alias("row_hash")))


@register("normalize_headers", """
SELECT c_custkey AS customer_key, c_name AS customer_name, c_mktsegment AS market_segment FROM customer""")
def normalize_headers(spark, d):
    from lotmarket.operators.clean import normalize_headers as norm
    c = table(spark, d, "customer").select(F.col("c_custkey").alias(" Customer Key "),
                                            F.col("c_name").alias("CUSTOMER NAME"),
                                            F.col("c_mktsegment").alias("Mkt Segment"))
    return finish(norm(c, "snake", {"mkt_segment": "market_segment"}))


REQUIRED = ["l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate", "sale_price", "borough"]


@register("schema_check", "SELECT r.col AS \"column\", r.col IN (SELECT column_name FROM (DESCRIBE lineitem)) AS present "
                          "FROM (VALUES " + ", ".join(f"('{c}')" for c in REQUIRED) + ") r(col)")
def schema_check(spark, d):
    """Required columns against the table's schema (metadata only, no scan)."""
    present = set(table(spark, d, "lineitem").columns)
    return spark.createDataFrame([(c, c in present) for c in REQUIRED], "column string, present boolean")
