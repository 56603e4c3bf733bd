"""The forest from drawn cells: the draws, one tree by hand, and quality against the library's fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotmarket.operators import forest, ml


def test_draws_are_poisson_counts_of_rows(spark, monkeypatch):
    """Counts and drawn targets by tree and cell, also where a crowded cell is dealt over several tasks."""
    monkeypatch.setattr(forest, "ROWS_PER_TASK", 300)
    monkeypatch.setattr(forest, "HELD", 500)
    rows = spark.range(2400).select(F.when(F.col("id") < 1600, 7).otherwise((F.col("id") % 40).cast("int")).alias("cell"),
                                    F.when(F.col("id") % 2 == 0, 1.0).otherwise(1000.0).alias("y"))
    frame = forest.drawn_cells(rows.select(F.col("cell").cast("int").alias("cell"), "y"), 30, 5)
    w, s = np.zeros((30, 40)), np.zeros((30, 40))
    for r in frame.collect():
        c = np.frombuffer(r.cell, np.int32)
        np.add.at(w[r.tree], c, np.frombuffer(r.w, np.int32))
        np.add.at(s[r.tree], c, np.frombuffer(r.s, np.float64))
    ones = (1000 * w - s) / 999  # drawn rows of target 1: a whole number of them
    assert np.allclose(ones, np.rint(ones)) and (ones >= 0).all() and (ones <= w).all()
    assert abs(w.sum(1).mean() / 2400 - 1) < 0.02 and 0.5 < w.sum(1).var() / 2400 < 1.9
    assert len({tuple(x) for x in w}) == 30 and 500 < ones[:, 7].mean() < 1100
    again = sorted(tuple(map(bytes, r[1:])) for r in frame.collect())
    assert again == sorted(tuple(map(bytes, r[1:])) for r in frame.collect())


def test_against_the_library(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor
    u = lambda seed: F.rand(seed)
    df = spark.range(6000, numPartitions=3).select("id", (u(1) * 10).alias("a"), (u(2) * 10).alias("b"), u(3).alias("n"), u(6).alias("m"))
    df = df.withColumn("y", F.when(F.col("a") > 5, 20.0).otherwise(0.0) - F.col("b") + 0.5 * F.randn(4))
    train, test, xs = df.where("id % 5 > 0"), df.where("id % 5 = 0"), ["a", "b", "n", "m"]
    model, va = ml.tree_fit(train, "y", xs, "rf", numTrees=20, maxDepth=6, seed=1)
    lib = RandomForestRegressor(labelCol="y", numTrees=20, maxDepth=6, seed=1).fit(va.transform(train))
    score = lambda m: ml.regression_metrics(m.transform(va.transform(test)).withColumnRenamed("prediction", "p"), "y", "p").first()["r2"]
    assert score(model) > 0.9 and score(model) > score(lib) - 0.03
    assert np.allclose(model.featureImportances.toArray(), lib.featureImportances.toArray(), atol=0.1)
    assert sum(model.featureImportances.toArray()) == pytest.approx(1)
    with pytest.raises(Exception, match="Labels MUST NOT"):
        ml.tree_fit(train.withColumn("y", F.when(F.col("id") == 1, None).otherwise(F.col("y"))), "y", xs, "rf", numTrees=2)
    for odd in (None, float("nan"), float("inf")):
        with pytest.raises(Exception, match="Vector values MUST NOT"):
            ml.tree_fit(train.withColumn("b", F.when(F.col("id") == 1, F.lit(odd).cast("double")).otherwise(F.col("b"))), "y", xs, "rf", numTrees=2)


def test_nothing_is_kept_for_each_row_and_tree(spark):
    """The library's fit persists a count for every row and tree, and writes node histograms from every task."""
    df = spark.range(3000).select((F.col("id") % 13).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("y"))
    drawn = forest.drawn_cells(df.select(F.col("a").cast("int").alias("cell"), "y"), 40, 1)
    assert sum(len(r.cell) // 4 for r in drawn.collect()) <= 13 * 40 * 2
    ml.tree_fit(df, "y", ["a"], "rf", numTrees=40, maxDepth=8, seed=1)
    assert not spark.sparkContext._jsc.getPersistentRDDs()
