"""Source/sink queries: round trips, JSON parsing, nested data,
multi-file ingest, partitioned appends, ad-hoc SQL, fingerprints."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotmarket.plans.binding import sales, table, with_sales
from lotmarket.plans.catalog import register
from lotmarket.plans.common import finish
from lotmarket.session import scratch_path
from lotmarket.sources import files as io

RT_COLS = ["l_orderkey", "l_linenumber", "borough_name", "neighborhood", "sale_price", "gross_sqft", "sale_date"]
RT_SQL = with_sales("SELECT " + ", ".join(c if c not in ("sale_price", "gross_sqft") else f"round({c}, 4) AS {c}"
                                          for c in RT_COLS) + " FROM sales")


def _rt(spark, d, fmt):
    return finish(io.roundtrip(spark, sales(spark, d).select(*RT_COLS), fmt, f"{fmt}-roundtrip"))


@register("csv_roundtrip", RT_SQL)
def csv_roundtrip(spark, d):
    return _rt(spark, d, "csv")


@register("json_roundtrip", RT_SQL)
def json_roundtrip(spark, d):
    return _rt(spark, d, "json")


@register("parquet_roundtrip", RT_SQL)
def parquet_roundtrip(spark, d):
    return _rt(spark, d, "parquet")


@register("append_partitioned", with_sales("""
SELECT sale_year, count(*) AS n, round(CAST(sum(CAST(sale_price AS DECIMAL(18,2))) AS DOUBLE), 4) AS total
FROM sales GROUP BY 1"""))
def append_partitioned(spark, d):
    s = sales(spark, d).select("l_orderkey", "l_linenumber", "sale_price", "flag", "sale_year")
    t = io.append_batches(spark, [s.where(F.col("flag") == "R"), s.where(F.col("flag") != "R")], ["sale_year"],
                          "append-partitioned")
    return finish(t.groupBy("sale_year").agg(F.count("*").alias("n"),
                                             F.sum(F.col("sale_price").cast("decimal(18,2)")).cast("double")
                                             .alias("total")))


@register("append_repeated", with_sales("""
SELECT sale_year, count(*) AS n, round(CAST(sum(CAST(sale_price AS DECIMAL(18,2))) AS DOUBLE), 4) AS total
FROM sales GROUP BY 1"""))
def append_repeated(spark, d):
    """The second load is written twice, as after a failure, and counts once."""
    s = sales(spark, d).select("l_orderkey", "l_linenumber", "sale_price", "flag", "sale_year")
    path = scratch_path(spark, "append-repeated")
    for load, rows in (("first", s.where("flag = 'R'")), ("second", s.where("flag <> 'R'")), ("second", s.where("flag <> 'R'"))):
        io.append_load(rows, path, load, ["sale_year"])
    t = spark.read.parquet(path)
    return finish(t.groupBy("sale_year").agg(F.count("*").alias("n"), F.sum(F.col("sale_price").cast("decimal(18,2)")).cast("double").alias("total")))


@register("json_map_explode", """
SELECT event_id, k AS key, coalesce(CAST(json_extract(props, '$."' || k || '"') AS BIGINT), 0) AS value
FROM events, unnest(json_keys(props)) AS t(k)""")
def json_map_explode(spark, d):
    e = table(spark, d, "events").select("event_id", "props")
    rows = io.json_map_rows(e, "props", T.LongType())
    return finish(rows.select("event_id", "key", F.coalesce(F.col("_v"), F.lit(0)).cast("bigint").alias("value")))


RECORD = T.StructType([T.StructField("population", T.LongType()), T.StructField("income", T.DoubleType()),
                       T.StructField("parks", T.LongType())])


@register("json_records", """
SELECT CAST(n.n_nationkey AS VARCHAR) AS key, count(*) AS population, round(avg(c.c_acctbal), 4) AS income,
       CAST(CASE WHEN any_value(n.n_regionkey) = 0 THEN 0 ELSE count(*) FILTER (WHERE c.c_mktsegment = 'BUILDING') END AS BIGINT) AS parks
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_nationkey""")
def json_records(spark, d):
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    agg = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).groupBy("n_nationkey", "n_regionkey").agg(
        F.count("*").alias("population"), F.avg("c_acctbal").alias("income"),
        F.count_if(F.col("c_mktsegment") == "BUILDING").alias("parks"))
    rec = F.struct("population", "income", F.when(F.col("n_regionkey") != 0, F.col("parks")).alias("parks"))
    text = agg.select(F.to_json(F.create_map(F.col("n_nationkey").cast("string"), rec)).alias("doc"))
    rows = io.json_map_rows(text, "doc", RECORD)
    return finish(io.defaults(rows, "_v", {"population": 0, "income": 0.0, "parks": 0}))


POI = T.StructType([
    T.StructField("neighborhood_id", T.LongType()), T.StructField("borough", T.StringType()),
    T.StructField("center_lat", T.DoubleType()), T.StructField("center_lon", T.DoubleType()),
    T.StructField("amenities", T.ArrayType(T.StructType([
        T.StructField("cat", T.StringType()), T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType())])))])


@register("nested_explode", """
SELECT CAST(p_partkey AS VARCHAR) AS key, p_brand AS borough, a.cat, round(a.lat, 4) AS lat, round(a.lon, 4) AS lon
FROM part LEFT JOIN LATERAL (
  SELECT * FROM (VALUES ('park', 40.5 + p_retailprice / 10000.0, -74.0 + p_size / 1000.0),
                        (lower(p_type), 40.6 + p_retailprice / 10000.0, -73.9 + p_size / 1000.0)) v(cat, lat, lon)
  WHERE p_size % 3 <> 0) a ON true""")
def nested_explode(spark, d):
    p = table(spark, d, "part")
    items = F.array(
        F.struct(F.lit("park").alias("cat"), (40.5 + F.col("p_retailprice") / 10000.0).alias("lat"),
                 (-74.0 + F.col("p_size") / 1000.0).alias("lon")),
        F.struct(F.lower("p_type").alias("cat"), (40.6 + F.col("p_retailprice") / 10000.0).alias("lat"),
                 (-73.9 + F.col("p_size") / 1000.0).alias("lon")))
    rec = F.struct(F.col("p_partkey").alias("neighborhood_id"), F.col("p_brand").alias("borough"),
                   F.lit(40.7).alias("center_lat"), F.lit(-74.0).alias("center_lon"),
                   F.when(F.col("p_size") % 3 != 0, items).alias("amenities"))
    docs = p.select(F.to_json(F.create_map(F.col("p_partkey").cast("string"), rec)).alias("doc"))
    rows = io.json_map_rows(docs, "doc", POI)
    flat = rows.select("key", F.col("_v.borough").alias("borough"), F.col("_v.amenities").alias("amenities"))
    ex = io.explode_nested(flat, "amenities", "a")
    return finish(ex.select("key", "borough", F.col("a.cat").alias("cat"), F.col("a.lat").alias("lat"),
                            F.col("a.lon").alias("lon")))


ADHOC = ("SELECT borough_name, building_type, count(*) AS n, round(avg(sale_price), 4) AS mean_price "
         "FROM {t} WHERE sale_year >= 1998 GROUP BY borough_name, building_type")


@register("sql_adhoc", with_sales(ADHOC.format(t="sales")))
def sql_adhoc(spark, d):
    sales(spark, d).createOrReplaceTempView("lotmarket_sales")
    return finish(spark.sql(ADHOC.format(t="lotmarket_sales")))


INGEST_COLS = ["l_orderkey", "l_linenumber", "borough_name", "sale_price", "gross_sqft", "land_sqft", "sale_date"]


@register("ingest_union", with_sales("""
SELECT l_orderkey AS L_ORDERKEY, l_linenumber AS L_LINENUMBER, borough_name AS BOROUGH_NAME,
       round(sale_price, 4) AS SALE_PRICE, round(gross_sqft, 4) AS GROSS_SQFT,
       round(CASE WHEN borough_name = 'AFRICA' THEN NULL ELSE land_sqft END, 4) AS LAND_SQFT, sale_date AS SALE_DATE,
       lower(replace(borough_name, ' ', '_')) AS SOURCE, DATE '2024-01-01' AS CRAWL_DATE,
       substring(md5(concat_ws(chr(1), CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), borough_name,
                 CAST(sale_price AS VARCHAR), CAST(gross_sqft AS VARCHAR),
                 CAST(CASE WHEN borough_name = 'AFRICA' THEN NULL ELSE land_sqft END AS VARCHAR),
                 CAST(sale_date AS VARCHAR))), 1, 16) AS ROW_HASH
FROM sales"""))
def ingest_union(spark, d):
    s = sales(spark, d).select(*INGEST_COLS)
    root = scratch_path(spark, "ingest")
    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    paths = {}
    for r in regions:
        part = s.where(F.col("borough_name") == r)
        if r == "AFRICA":  # this source ships without the land column
            part = part.drop("land_sqft")
        src = r.lower().replace(" ", "_")
        paths[src] = f"{root}/{src}"
        io.write(part, paths[src], "parquet")
    return finish(io.ingest_files(spark, paths, "parquet", crawl_date="2024-01-01", columns=INGEST_COLS))


@register("file_fingerprint")
def file_fingerprint(spark, d):
    """Rows-only: MD5 prefix of every table file (binaryFile source)."""
    return finish(io.file_fingerprints(spark, f"{d.rstrip('/')}/*.parquet"))


#: Small enough that the tables' files have several ranges each; the operator's default is 64 MB.
PRINT_RANGE = 1 << 16


@register("file_range_print")
def file_range_print(spark, d):
    """S8 for files of any size: a print of every table file from digests of its ranges, each range a task's row."""
    return finish(io.file_range_prints(spark, f"{d.rstrip('/')}/*.parquet", PRINT_RANGE))


# Row cap (T8): the first N rows in a total order.
ROW_CAP = 1000
CAP_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


@register("row_cap", f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity
FROM lineitem ORDER BY {', '.join(CAP_ORDER)} LIMIT {ROW_CAP}""")
def row_cap(spark, d):
    li = table(spark, d, "lineitem").select(*CAP_ORDER)
    return finish(li.orderBy(*CAP_ORDER).limit(ROW_CAP))


SAMPLE_ROWS = 1500


@register("seeded_sample", f"""
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY md5(concat_ws('-', '42', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))), l_orderkey, l_linenumber LIMIT {SAMPLE_ROWS}""")
def seeded_sample(spark, d):
    """Reproducible sample of N rows without replacement, in the order of a seeded hash of the key."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    key = F.md5(F.concat_ws("-", F.lit("42"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    return finish(li.orderBy(key, "l_orderkey", "l_linenumber").limit(SAMPLE_ROWS))


FORMATS = ("csv", "json", "orc", "parquet")


@register("format_dispatch", f"""
SELECT f.format, count(*) AS n, round(sum(s_acctbal), 4) AS total, CAST(sum(length(s_name)) AS BIGINT) AS name_chars
FROM supplier CROSS JOIN (VALUES {", ".join(f"('{f}')" for f in FORMATS)}) f(format) GROUP BY 1""")
def format_dispatch(spark, d):
    """The same rows written and read in each format."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    out = None
    for fmt in FORMATS:
        back = io.roundtrip(spark, s, fmt, f"format-{fmt}").select(F.lit(fmt).alias("format"), "s_name", "s_acctbal")
        out = back if out is None else out.unionByName(back)
    return finish(out.groupBy("format").agg(F.count("*").alias("n"), F.sum("s_acctbal").alias("total"), F.sum(F.length("s_name")).alias("name_chars")))


@register("full_refresh", "SELECT o_orderkey, o_custkey, round(o_totalprice, 4) AS o_totalprice FROM orders")
def full_refresh(spark, d):
    """An old state is published, then the whole table; readers get the new version."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    root = scratch_path(spark, "orders-published")
    io.publish(o.where(F.col("o_orderkey") % 2 == 0), root)
    io.publish(o, root)
    return finish(io.current(spark, root))


@register("json_array", "SELECT c_custkey, c_name, round(c_acctbal, 4) AS c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer")
def json_array(spark, d):
    """Files that hold one JSON array of records each (here a file per nation and thousand keys), read as such."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    part = (F.col("c_custkey") / 1000).cast("int").alias("part")
    arrays = c.groupBy("c_nationkey", part).agg(F.to_json(F.collect_list(F.struct("c_custkey", "c_name", "c_acctbal"))).alias("value"))
    path = scratch_path(spark, "json-arrays")
    arrays.repartition("c_nationkey", "part").write.partitionBy("c_nationkey", "part").text(path)
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()), T.StructField("c_acctbal", T.DoubleType()),
                           T.StructField("c_nationkey", T.LongType())])
    return finish(io.read(spark, path, "json", schema, multiLine=True).select("c_custkey", "c_name", "c_acctbal", F.col("c_nationkey").cast("bigint").alias("c_nationkey")))
