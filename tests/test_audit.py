"""The audit trail's counts, and that the source is read once for them."""

from datetime import datetime

import duckdb
from pyspark.sql import functions as F

from lotmarket.operators import clean
from lotmarket.operators import relational as rel
from lotmarket.plans.catalog import oracle_sql, queries
from lotmarket.plans.clean_q import PIPE_B

STEPS = [("dedup", rel.dedup_full), ("sparse", clean.drop_sparse_seen(50.0)), ("fill", lambda df: clean.impute_const(df, {"a": 0})),
         ("keep", lambda df: df.where("a < 3"))]


def test_trail_and_rows(spark, tmp_path, monkeypatch):
    rows = [(1, None, "x"), (1, None, "x"), (None, None, "y"), (4, "s", None)]
    spark.createDataFrame(rows, "a int, b string, c string").write.parquet(str(tmp_path / "source"))
    plans = []
    whole = clean.materialize

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return whole(df, name)

    monkeypatch.setattr(clean, "materialize", watched)
    out, trail = clean.audited(spark.read.parquet(str(tmp_path / "source")), STEPS, ["a", "b", "c"])
    assert sorted((tuple(r) for r in out.collect()), key=str) == [(0, "y"), (1, "x")]
    got = {(r.step, r.metric, r.column): (r.before, r.after) for r in trail.collect()}
    assert got["dedup", "rows", None] == (4, 3) and got["dedup", "nulls", "b"] == (3, 2) and got["dedup", "columns", None] == (3, 3)
    assert got["sparse", "columns", None] == (3, 2) and got["sparse", "nulls", "b"] == (2, None) and got["sparse", "rows", None] == (3, 3)
    assert got["fill", "nulls", "a"] == (1, 0) and got["fill", "nulls", "c"] == (1, 1)
    assert got["keep", "rows", None] == (3, 2) and ("keep", "nulls", "b") not in got
    assert sum(p.count("FileScan") for p in plans if "/source" in p) == 1


def test_empty_source(spark):
    out, trail = clean.audited(spark.createDataFrame([], "a int, b string"), STEPS, ["a"])
    assert out.count() == 0 and out.columns == ["a", "b"]
    assert trail.where(F.col("metric") == "rows").agg(F.sum("after")).first()[0] == 0


def test_rows_of_a_step_that_keeps_none(spark, tmp_path):
    spark.createDataFrame([(1, None), (2, "y"), (2, "y")], "a int, b string").write.parquet(str(tmp_path / "source"))
    steps = [("dedup", rel.dedup_full), ("none", lambda df: df.where(F.lit(False))), ("flag", lambda df: df.withColumn("f", F.lit(1)))]
    out, trail = clean.audited(spark.read.parquet(str(tmp_path / "source")), steps, ["a", "b", "f"])
    assert out.count() == 0 and out.columns == ["a", "b", "f"]
    got = {(r.step, r.metric, r.column): (r.before, r.after) for r in trail.collect()}
    assert got["dedup", "rows", None] == (3, 2) and got["dedup", "nulls", "b"] == (1, 1)
    assert got["none", "rows", None] == (2, 0) and got["none", "nulls", "b"] == (1, 0) and got["flag", "rows", None] == (0, 0)
    assert got["flag", "columns", None] == (2, 3) and got["flag", "nulls", "f"] == (None, 0)


def star(spark, folder, lines):
    """The tables of the sales frame: one order of one customer, two parts, and the given fact rows."""
    tables = {
        "region": ([(1, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(7, " Japan ", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(5, 7, "BUILDING", 10.0)], "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double"),
        "orders": ([(1, 5, datetime(1995, 1, 2), 9.0)], "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double"),
        "part": ([(1, "SMALL", "B#1", "red", 900.0, 3), (2, "LARGE", "B#2", None, 950.0, None)],
                 "p_partkey long, p_type string, p_brand string, p_name string, p_retailprice double, p_size int"),
        "lineitem": ([(1, n, part, 1, price, area, discount, tax, flag, datetime(1996, 1, 2)) for n, part, price, area, discount, tax, flag in lines],
                     "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double, "
                     "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def by_sql(folder):
    db = duckdb.connect()
    for name in ("region", "nation", "customer", "orders", "part", "lineitem"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    return sorted(db.execute(oracle_sql()["clean_audit"]).fetchall(), key=str)


def test_clean_audit_reports_every_step_and_column(spark, tmp_path):
    lines = [(1, 1, 500.0, 4.0, 0.1, 0.01, "R"), (1, 1, 500.0, 4.0, 0.1, 0.01, "R"), (2, 2, None, 5.0, 0.0, 0.08, "A"),
             (2, 2, 600.0, 5.0, 0.0, 0.08, "A"), (3, 1, 700.0, 6.0, 0.2, 0.0, "N"), (4, 1, 200000.0, 7.0, 0.2, 0.02, "N")]
    trail = sorted((tuple(r) for r in queries()["clean_audit"](spark, star(spark, tmp_path, lines)).collect()), key=str)
    got = {r[:3]: r[3:] for r in trail}
    assert len(got) == len(trail) and trail == by_sql(tmp_path)
    assert [got[s, "rows", None] for s, _ in PIPE_B] == [(6, 5), (5, 4), (4, 4), (4, 4), (4, 4), (4, 4), (4, 4)]
    assert [got[s, "columns", None] for s, _ in PIPE_B] == [(14, 14), (14, 14), (14, 12), (12, 12), (12, 12), (12, 12), (12, 14)]
    assert got["dedup_key", "nulls", "building_type"] == (1, 1) and got["dedup_key", "nulls", "address"] == (2, 1)
    assert got["drop_sparse", "nulls", "apartment"] == (3, None) and got["drop_sparse", "nulls", "easement"] == (4, None)
    assert got["fill", "nulls", "land_sqft"] == (1, 0) and got["text", "nulls", "address"] == (1, 1)
    assert got["flags", "nulls", "is_luxury"] == (None, 1) and ("fill", "nulls", "apartment") not in got


def test_clean_audit_goes_on_without_a_dropped_column(spark, tmp_path):
    lines = [(n, 2, 500.0 if n == 1 else None, 4.0, 0.0, 0.0, "N") for n in (1, 2, 3)]
    trail = sorted((tuple(r) for r in queries()["clean_audit"](spark, star(spark, tmp_path, lines)).collect()), key=str)
    got = {r[:3]: r[3:] for r in trail}
    assert trail == by_sql(tmp_path)
    # building_type, address, sale_price, gross_sqft, total_units, apartment and easement are missing too often
    assert got["drop_sparse", "columns", None] == (14, 7) and got["flags", "columns", None] == (7, 7)
    assert got["drop_sparse", "nulls", "sale_price"] == (2, None) and ("flags", "nulls", "is_luxury") not in got
