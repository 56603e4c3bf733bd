"""Scoring, quality and source operators on hand-made frames."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotmarket.operators import quality as qa
from lotmarket.operators import relational as rel
from lotmarket.operators import scoring as sc
from lotmarket.session import scratch_path
from lotmarket.sources import files as io


def test_livability_missing_scores_half(spark):
    wide = spark.createDataFrame([("r", None)], "region string, crime double")
    pillars = [(15, [("crime", 1.0, 0, 15000)]), (10, [("absent", 1.0, 0, 10)])]
    got = sc.livability(wide, "region", pillars, ["crime"]).first().livability
    assert got == 12.5  # 15 * 0.5 + 10 * 0.5


def test_invest_score_and_rank(spark):
    liv = spark.createDataFrame([("a", 80.0), ("b", 60.0)], "region string, livability double")
    med = spark.createDataFrame([("a", 100.0), ("b", 50.0)], "region string, median double")
    got = {r.region: r.invest_score for r in sc.invest_score(liv, med, "region").collect()}
    assert got == {"a": 48.0, "b": 56.0}


def test_indicator_standing_bands(spark):
    long = spark.createDataFrame([("x", "a", 1.0), ("x", "b", 2.0), ("x", "c", 3.0), ("y", "a", 5.0), ("y", "b", 5.0)],
                                 "indicator string, region string, value double")
    dirs = spark.createDataFrame([("x", True), ("y", True), ("z", False)], "indicator string, high_is_good boolean")
    got = {(r.indicator, r.region): r.band for r in sc.indicator_standing(long, "region", dirs).collect()}
    assert got[("x", "a")] == "worst" and got[("x", "b")] == "good" and got[("x", "c")] == "best"
    assert got[("y", "a")] == "neutral" and got[("z", None)] is None


def test_range_join_counts_overlaps_twice(spark):
    pts = spark.createDataFrame([(1.0, 1.0, "p"), (5.0, 5.0, "p"), (9.0, 9.0, "q")], "lat double, lon double, cls string")
    boxes = [("A", 0, 0, 6, 6), ("B", 4, 4, 10, 10)]
    got = {(r.name, r.cls): r.n for r in rel.range_join_count(pts, boxes, "lat", "lon", "cls").collect()}
    assert got == {("A", "p"): 2, ("B", "p"): 1, ("B", "q"): 1}


def test_threshold_and_reconcile(spark):
    df = spark.createDataFrame([(500.0, 1990), (2000.0, 1700), (None, 2000)], "price double, year int")
    got = {r.column: r.violations for r in qa.threshold_violations(df, {"price": (1000, 1e8), "year": (1800, 2026)}).collect()}
    assert got == {"price": 1, "year": 1}
    a = spark.createDataFrame([(100.0,), (200.0,)], "v double")
    b = spark.createDataFrame([(299.0,)], "v double")
    r = qa.reconcile_sum(a, "v", b, "v").first()
    assert r.ok and r.source_sum == 300.0


def test_validation_report(spark):
    df = spark.createDataFrame([("s1", 1, None), ("s1", 1, None), ("s1", None, None), ("s2", 2, 3)],
                               "src string, a int, b int")
    got = {r.src: (r.total, r.invalid, r.duplicates, r.issues) for r in qa.validation_report(df, "src", ["a", "b"], ["a", "b"]).collect()}
    assert got["s1"] == (3, 1, 1, "empty rows;duplicate rows") and got["s2"] == (1, 0, 0, "")


def test_json_map_with_defaults_and_nested(spark):
    doc = json.dumps({"1": {"population": 10, "income": 2.5}, "2": {"population": 3}})
    df = spark.createDataFrame([(doc,)], "doc string")
    rec = T.StructType([T.StructField("population", T.LongType()), T.StructField("income", T.DoubleType())])
    rows = io.defaults(io.json_map_rows(df, "doc", rec), "_v", {"population": 0, "income": 0.0})
    assert sorted((r.key, r.population, r.income) for r in rows.collect()) == [("1", 10, 2.5), ("2", 3, 0.0)]
    nested = spark.createDataFrame([("k", [("park", 1.0)]), ("n", None)], "key string, items array<struct<cat:string,x:double>>")
    got = sorted((r.key, r.it.cat if r.it else None) for r in io.explode_nested(nested, "items", "it").collect())
    assert got == [("k", "park"), ("n", None)]


def test_csv_roundtrip_and_ingest(spark):
    df = spark.createDataFrame([(1, "a", 2.5)], "id int, name string, v double")
    back = io.roundtrip(spark, df, "csv", "t-csv")
    assert back.collect() == df.collect()
    root = scratch_path(spark, "t-ingest")
    io.write(df, f"{root}/north", "parquet")
    io.write(df.drop("v"), f"{root}/south", "parquet")
    out = io.ingest_files(spark, {"N": f"{root}/north", "S": f"{root}/south"}, columns=["id", "name", "v"])
    got = sorted((r.SOURCE, r.V) for r in out.collect())
    assert got == [("N", 2.5), ("S", None)]
