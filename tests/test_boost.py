"""Boosted trees from cells: splits against brute force, and quality against a row-wise library fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotmarket.operators import boost as B


def planted(spark, n=6000):
    u = lambda seed: F.rand(seed)
    df = spark.range(n, numPartitions=4).select("id", (u(1) * 10).alias("a"), (u(2) * 10).alias("b"), u(3).alias("noise"), F.randn(4).alias("e"))
    y = F.when(F.col("a") > 5, 20.0).otherwise(0.0) + F.when(F.col("b") > 7, F.col("a")).otherwise(-F.col("b")) + 0.3 * F.col("e")
    return df.withColumn("y", y)


def r2(df):
    e = F.col("y") - F.col("p")
    return df.agg(1 - F.sum(e * e) / (F.var_pop("y") * F.count("y"))).first()[0]


def test_first_split_is_the_best_of_all():
    rng = np.random.default_rng(2)
    bins, w, r = rng.integers(0, 6, (200, 3)), rng.integers(1, 9, 200).astype(float), rng.normal(size=200)
    feature, cut, value, _ = B.grow(bins, w, r, 6, 1, 1.0)

    def cost(sel):
        return (w[sel] * (r[sel] - np.average(r[sel], weights=w[sel])) ** 2).sum() if sel.any() else np.inf

    costs = {(f, c): cost(bins[:, f] <= c) + cost(bins[:, f] > c) for f in range(3) for c in range(5)}
    assert costs[feature[0], cut[0]] == pytest.approx(min(costs.values()))
    assert value[1] == pytest.approx(np.average(r[bins[:, feature[0]] <= cut[0]], weights=w[bins[:, feature[0]] <= cut[0]]))


def test_cells_stand_for_their_rows():
    """A cell of weight n is n rows: the same trees."""
    rng = np.random.default_rng(3)
    cells, n = rng.integers(0, 4, (40, 2)), rng.integers(1, 6, 40)
    cells, first = np.unique(cells, axis=0, return_index=True)
    n, mean = n[first], rng.normal(size=len(first))
    bounds = [[1.0, 2.0, 3.0]] * 2
    a = B.boost(cells, n.astype(float), n * mean, 20, 3, 0.3, 1.0, 1, bounds)
    b = B.boost(np.repeat(cells, n, axis=0), np.ones(n.sum()), np.repeat(mean, n), 20, 3, 0.3, 1.0, 1, bounds)
    assert np.array_equal(a.feature, b.feature) and np.array_equal(a.cut, b.cut) and np.allclose(a.value, b.value)
    assert a.value[0].any()


def test_grid_and_list_of_cells_grow_the_same_trees(monkeypatch):
    rng = np.random.default_rng(5)
    rows, y = rng.integers(0, (4, 7, 5), (900, 3)), rng.normal(size=900)
    cells, at = np.unique(rows, axis=0, return_inverse=True)
    w, s = np.bincount(at).astype(float), np.bincount(at, y)
    bounds = [[float(i) for i in range(n - 1)] for n in (4, 7, 5)]
    monkeypatch.setattr(B, "DENSE", 0)
    a = B.boost(cells, w, s, 30, 4, 0.2, 0.8, 1, bounds)
    monkeypatch.setattr(B, "DENSE", 1000)
    b = B.boost(cells, w, s, 30, 4, 0.2, 0.8, 1, bounds)
    assert np.array_equal(a.feature, b.feature) and np.array_equal(a.cut, b.cut) and np.allclose(a.value, b.value) and np.allclose(a.gain, b.gain)
    painted = np.full(B.grid_shape(bounds), a.base)
    one_by_one = np.full(len(cells), a.base)
    for t in range(30):
        B.paint(painted, a.feature[t], a.cut[t], a.value[t])
        one_by_one += B.leaf_values(a, t, cells)
    assert a.table is None and np.allclose(b.table, painted) and np.array_equal(painted.ravel()[B.slots(cells, painted.shape)], one_by_one)


def test_rows_are_scored_the_same_way_alone_and_from_the_grid(spark, monkeypatch):
    df = planted(spark, 3000)
    model = B.fit_boosted(df, "y", ["a", "b"], rounds=20, depth=3)
    alone = B.predict_boosted(df, model._replace(table=None), ["a", "b"], "p").orderBy("id").collect()
    monkeypatch.setattr(B, "SINGLE_ROWS", 10)
    painted = B.predict_boosted(df, model._replace(table=None), ["a", "b"], "p").orderBy("id").collect()
    assert model.table is not None and [r.p for r in alone] == [r.p for r in painted]
    assert [r.p for r in alone] == pytest.approx([r.p for r in B.predict_boosted(df, model, ["a", "b"], "p").orderBy("id").collect()])


def test_a_full_grid_is_grown_quickly():
    """Trees on all combinations of 24 bins of four features: the grid takes less than the list of cells."""
    import time
    cells = np.stack(np.unravel_index(np.arange(24**4), (24,) * 4), axis=1)
    rng = np.random.default_rng(1)
    w, mean = rng.integers(1, 6, len(cells)).astype(float), rng.normal(size=len(cells))
    bounds = [[float(i) for i in range(23)]] * 4

    def cost(dense):
        B_DENSE, B.DENSE = B.DENSE, dense
        try:
            start = time.process_time()
            B.boost(cells, w, w * mean, 3, 7, 0.05, 1.0, 1, bounds)
            return time.process_time() - start
        finally:
            B.DENSE = B_DENSE

    assert cost(20) < 0.6 * cost(0)


def test_against_a_row_wise_fit(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    df = planted(spark)
    train, test = df.where("id % 5 > 0"), df.where("id % 5 = 0")
    xs = ["a", "b", "noise"]
    model = B.fit_boosted(train, "y", xs, rounds=60, depth=4, step=0.1, subsample=0.8)
    mine = r2(B.predict_boosted(test, model, xs, "p"))
    va = VectorAssembler(inputCols=xs, outputCol="features")
    lib = GBTRegressor(labelCol="y", maxIter=20, maxDepth=4, stepSize=0.1, seed=1).fit(va.transform(train))
    theirs = r2(lib.transform(va.transform(test)).withColumnRenamed("prediction", "p"))
    assert mine > 0.95 and mine > theirs - 0.02
    imp, other = model.importances(), lib.featureImportances.toArray()
    assert imp[2] < 0.02 and np.argsort(imp).tolist()[::-1][0] == int(np.argmax(other)) and sum(imp) == pytest.approx(1)


def test_nulls_weights_and_bounds(spark):
    rows = [(None, 1.0, 2.0), (1.0, None, 1.0), (2.0, float("nan"), 1.0), (3.0, 5.0, 3.0), (None, 3.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, y double, w double")
    cells = B.cell_table(df, "y", ["a"], [[1.5]], "w").orderBy("b0").collect()
    assert [tuple(r) for r in cells] == [(0, 3.0, 5.0), (1, 3.0, 15.0)]
    model = B.fit_boosted(df, "y", ["a"], rounds=200, depth=1, step=0.2, subsample=1.0, bins=4, weight="w")
    got = [round(r.p, 3) for r in B.predict_boosted(df.where("y = 5"), model, ["a"], "p").collect()]
    assert got == [5.0]
    with pytest.raises(ValueError, match="cells"):
        B.fit_boosted(df, "y", ["a"] * 5, bins=32)
    with pytest.raises(ValueError, match="no rows"):
        B.fit_boosted(df.where("w > 9"), "y", ["a"], rounds=2)
