"""Results of the corrected operators against numbers worked out by hand."""

import pytest
from pyspark.sql import functions as F

from lotmarket.operators import market as mk
from lotmarket.operators import ml
from lotmarket.operators import trend as tr
from lotmarket.plans import ml_q


def test_hash_buckets_of_two_seeds_are_independent(spark):
    df = spark.range(20000).select(F.col("id").alias("k"), ml.hash_bucket(["id"], 5, 11).alias("a"), ml.hash_bucket(["id"], 4, 7).alias("b"))
    cells = df.groupBy("a", "b").count().collect()
    assert len(cells) == 20
    # chi-square with 19 degrees of freedom: 43.8 is its 99.9 percent point
    assert sum((c["count"] - 1000) ** 2 / 1000 for c in cells) < 43.8


def test_fold_verdicts(spark):
    def verdict(scores, hold):
        s = spark.createDataFrame([(float(x),) for x in scores], "r2 double")
        return ml.cv_summary(s, spark.createDataFrame([(hold,)], "r2 double")).first()

    steady, shaky = verdict([.5, .51, .52], .5), verdict([.5, .6], .7)
    assert (steady["verdict"], steady["overfit"]) == ("very good", "safe")
    assert (shaky["verdict"], shaky["overfit"]) == ("needs work", "overfit")


def test_learning_curve_reaches_all_rows_and_judges_the_last_size(spark):
    df = spark.range(900).select((F.col("id") % 3).alias("fold"), F.pmod(F.col("id") * 37, F.lit(100)).alias("b"),
                                 F.col("id").cast("double").alias("x1"), (F.col("id") % 7).cast("double").alias("x2"))
    df = df.withColumn("y", 3 * F.col("x1") - F.col("x2"))
    got = {r["size"]: r for r in ml.learning_curve(df, "y", ["x1", "x2"], "fold", 3, "b", ml_q.SIZES).collect()}
    assert sorted(got) == [10, 28, 46, 64, 82, 100]
    assert got[100]["mean_train_rows"] == 600 and got[100]["verdict"] == "good" and got[82]["verdict"] is None


def test_forecast_numbers_months_without_gaps(spark):
    """Months 0, 1, 2, 3 after the filter with values 1, 4, 9, 16: the next are 25 and 36, whatever the calendar says."""
    rows = [("a", t, float((t + 1) ** 2)) for t in range(4)]
    got = tr.poly_forecast(spark.createDataFrame(rows, "k string, t bigint, y double"), "k", "t", "y", horizon=2).orderBy("step").collect()
    assert [r["forecast"] for r in got] == pytest.approx([25, 36])


def test_every_year_has_its_change(spark):
    rows = [("a", 1990, 100.0), ("a", 1991, 150.0), ("a", 2031, 300.0), ("b", 2031, 5.0)]
    got = mk.yoy_by_year(spark.createDataFrame(rows, "k string, y int, v double"), "k", "y", "v").collect()
    assert sorted((r["k"], r["y"], r["yoy_pct"], r["years_back"]) for r in got if r["k"] == "a") == [("a", 1990, None, 3), ("a", 1991, 50.0, 2), ("a", 2031, 100.0, 1)]
    assert next(r for r in got if r["k"] == "b")["yoy_pct"] is None


def test_unseen_keys_are_encoded_as_the_mean(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 8.0)], "k string, y double")
    enc = ml.median_encoding(train, "k", "y", "e")
    got = {r["k"]: r["e"] for r in ml.encode(spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), enc, "k", "e").collect()}
    import math
    half = (math.log1p(8) - math.log1p(2)) / 2
    assert got == pytest.approx({"a": -half, "b": half, "c": 0.0})


def test_distinct_requests_have_distinct_values(spark):
    rows = ml_q.batch_valuation(spark, "/root/testdata/sf0.01").collect()
    assert len({round(r["value"], 2) for r in rows}) > 0.9 * len(rows) > 100


def test_trees(spark):
    """Importances sum to 1; where there is something to learn, boosted trees beat the mean.  (The stand-in prices
    don't depend on the stand-in features, so this is shown on made rows.)"""
    imp = {r["feature"]: r["importance"] for r in ml_q.rf_fit(spark, "/root/testdata/sf0.001", numTrees=10, maxDepth=6).collect()}
    assert set(imp) == set(ml_q.TREE_XS) and sum(imp.values()) == pytest.approx(1.0, abs=1e-3)
    df = spark.range(4000).select(*[(F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(1000)) / 1000).alias(x) for i, x in enumerate(["x1", "x2"])])
    df = df.withColumn("y", F.when(F.col("x1") > 0.5, 10.0).otherwise(2.0) + F.col("x2"))
    model, va = ml.tree_fit(df, "y", ["x1", "x2"], "gbt", maxIter=8, maxDepth=4, stepSize=0.3, seed=42)
    fitted = model.transform(va.transform(df)).withColumn("p", F.col("prediction"))
    assert ml.regression_metrics(fitted, "y", "p").first()["r2"] > 0.9
    assert ml.importance_table(model, ["x1", "x2"], spark).orderBy(F.desc("importance")).first()["feature"] == "x1"
