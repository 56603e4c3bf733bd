"""Operators on hand-made frames with the edge rows of FIXTURES.md part C."""

import datetime as dt

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from lotmarket.operators import clean as cl
from lotmarket.operators import market as mk
from lotmarket.operators import ml
from lotmarket.operators import relational as rel
from lotmarket.operators import trend as tr
from lotmarket.operators import warehouse as wh


def test_dedup_first_keeps_first_in_order(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "a"), (2, 9, "z"), (1, 3, "c")], "k int, o int, p string")
    got = sorted((r.k, r.o, r.p) for r in rel.dedup_first(df, "k", ["o", "p"]).collect())
    assert got == [(1, 3, "a"), (2, 9, "z")]


def test_dup_count_and_dedup_full(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert rel.dup_count(df).first().duplicate_rows == 1
    assert rel.dedup_full(df).count() == 2


def test_insert_or_ignore(spark):
    t = spark.createDataFrame([(1, "old")], "k int, v string")
    inc = spark.createDataFrame([(1, "new"), (2, "x"), (2, "y")], "k int, v string")
    out = rel.insert_or_ignore(t, inc, "k")
    assert out.count() == 2 and out.where("k = 1").first().v == "old"


def test_resolve_fk_default_and_same_name_two_parents(spark):
    fact = spark.createDataFrame([("A", 1), ("A", 2), ("Z", 1)], "name string, parent int")
    dim = spark.createDataFrame([("A", 1, 10), ("A", 2, 20)], "n string, p int, id int")
    got = sorted((r.name, r.parent, r.id) for r in
                 rel.resolve_fk(fact, dim, {"name": "n", "parent": "p"}, "id", 1).collect())
    assert got == [("A", 1, 10), ("A", 2, 20), ("Z", 1, 1)]


def test_impute_mode_ties_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "v string")
    got = [r.v for r in cl.impute_mode(df, ["v"]).collect()]
    assert got.count("a") == 3


def test_iqr_clip_keeps_nulls_and_rows(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    out = [r.v for r in cl.iqr_clip(df, ["v"]).collect()]
    q1, q3 = np.percentile([1, 2, 3, 4, 100], [25, 75])
    assert len(out) == 6 and None in out
    assert max(x for x in out if x is not None) == q3 + 1.5 * (q3 - q1)


def test_sparse_columns_threshold(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1, None), (3, None, 5), (4, 2, None)], "a int, b int, c int")
    # b is exactly 50 % missing -> kept; c is 75 % missing -> dropped
    assert cl.sparse_columns(df, 50.0) == ["c"]


def test_returns_r2_zero_for_constant_and_filters(spark):
    rows = [("flat", dt.date(2020, m, 1), 100.0, 5) for m in (1, 2, 3)]
    rows += [("two", dt.date(2020, m, 1), 100.0 * m, 5) for m in (1, 2)]
    rows += [("up", dt.date(2020, m, 1), 100.0 * m, 3) for m in (1, 2, 3)]
    s = spark.createDataFrame(rows, "g string, month date, median double, n long")
    out = {r.g: r for r in tr.returns_table(s, "g", min_months=3, min_n=10).collect()}
    assert set(out) == {"flat"}  # 'two' has 2 months, 'up' has 9 rows
    assert out["flat"].r2 == 0.0 and out["flat"].return_pct == 0.0


def test_confidence_formula(spark):
    df = spark.createDataFrame([(250, 24, 0.9), (50, 6, 0.5), (10, 3, None)], "n long, months long, r2 double")
    got = [r.c for r in df.select(tr.confidence().alias("c")).collect()]
    assert got == [97.0, 50.0, 12.0]


def test_fill_gaps_forward_then_back(spark):
    s = spark.createDataFrame([("g", dt.date(2020, 1, 1), None), ("g", dt.date(2020, 2, 1), 5.0),
                               ("g", dt.date(2020, 4, 1), 7.0)], "k string, month date, median double")
    got = [(r.month.month, r.median, r.filled) for r in tr.fill_gaps(s, "k").orderBy("month").collect()]
    assert got == [(1, 5.0, True), (2, 5.0, False), (3, 5.0, True), (4, 7.0, False)]


def test_poly_forecast_matches_polyfit(spark):
    ys = [3.0, 5.0, 4.0, 8.0, 9.0, 13.0, 12.0]
    df = spark.createDataFrame([("g", float(t), y) for t, y in enumerate(ys, 1)], "k string, t double, y double")
    out = [r.forecast for r in tr.poly_forecast(df, "k", "t", "y", horizon=2).orderBy("step").collect()]
    coef = np.polyfit(np.arange(1, 8), ys, 2)
    assert np.allclose(out, np.polyval(coef, [8, 9]))


def test_dense_ids_are_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7 % 5000).alias("k"))
    out = wh.dense_ids(df, ["k"], "sid", partitions=6)
    rows = out.orderBy("k").collect()
    assert [r.sid for r in rows] == list(range(1, 5001))


def test_ols_matches_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    df = spark.range(2000).select((F.col("id") % 37).cast("double").alias("x1"),
                                  (F.col("id") % 11).cast("double").alias("x2"))
    df = df.withColumn("y", 3 + 2 * F.col("x1") - 0.5 * F.col("x2") + (F.pmod(F.xxhash64("x1", "x2"), F.lit(7))))
    c = ml.ols_fit(df, "y", ["x1", "x2"]).first()
    lr = LinearRegression(featuresCol="f", labelCol="y", solver="normal", regParam=0.0).fit(
        VectorAssembler(inputCols=["x1", "x2"], outputCol="f").transform(df))
    assert np.allclose([c.b0, c.b1, c.b2], [lr.intercept, *lr.coefficients], rtol=1e-8)


def test_kfold_equals_direct_fits(spark):
    df = spark.range(3000).select("id", (F.col("id") % 50).cast("double").alias("x1"),
                                  (F.col("id") % 13).cast("double").alias("x2"), (F.col("id") % 5).alias("fold"))
    df = df.withColumn("y", F.col("x1") * 3 + F.pmod(F.xxhash64("id"), F.lit(100)).cast("double"))
    got = {r.fold: r.r2 for r in ml.kfold_linear_r2(df, "y", ["x1", "x2"], "fold", 5).collect()}
    for f in range(5):
        coef = ml.ols_fit(df.where(F.col("fold") != f), "y", ["x1", "x2"])
        p = ml.predict_linear(df.where(F.col("fold") == f), coef, ["x1", "x2"], "p")
        r2 = ml.r2_by_fit(p.withColumn("one", F.lit(1)), "y", "p", ["one"]).first().r2
        assert abs(got[f] - r2) < 1e-9


def test_hash_split_fractions(spark):
    df = spark.range(20000).select((F.col("id") * 3).alias("a"), (F.col("id") % 7).alias("b"))
    b = ml.hash_bucket(["a", "b"], 100, 42)
    frac = df.where(b < 80).count() / 20000
    assert 0.77 < frac < 0.83


def test_loan_zero_rate_branch(spark):
    from lotmarket.operators.scoring import loan_costs
    df = spark.createDataFrame([(300000.0, 0.0, 30, 20.0), (300000.0, 6.5, 30, 20.0)],
                               "price double, rate double, years long, down double")
    r = loan_costs(df, "price", "rate", "years", "down").orderBy("rate").collect()
    assert r[0].monthly_payment == 240000.0 / 360 and r[0].total_interest == 0.0
    i = 0.065 / 12
    assert abs(r[1].monthly_payment - 240000 * i * (1 + i) ** 360 / ((1 + i) ** 360 - 1)) < 1e-6


def test_poly_forecast_of_one_and_two_points(spark):
    """Fewer points than a parabola needs: a constant through one, a line through two."""
    rows = [("one", 0, 5.0), ("two", 0, 1.0), ("two", 1, 4.0)]
    df = spark.createDataFrame(rows, "k string, t bigint, y double")
    got = {k: [] for k in ("one", "two")}
    for r in tr.poly_forecast(df, "k", "t", "y", horizon=2, min_points=1).orderBy("k", "step").collect():
        got[r.k].append(round(r.forecast, 9))
    assert got == {"one": [5.0, 5.0], "two": [7.0, 10.0]}


def test_flag_top_against_a_window(spark):
    """Ties, NULL keys and NULL values rank as in one window over the whole table; no task sorts the table."""
    rows = [(None if i == 7 else f"a{i}", i % 3, None if i % 5 == 0 else float(i % 4)) for i in range(40)]
    df = spark.createDataFrame(rows, "area string, part bigint, v double").repartition(6)
    order = [F.desc("v"), "area"]
    got = mk.flag_top(df, ["area", "part"], order, 12, "top")
    want = df.withColumn("top", F.row_number().over(Window.orderBy(*order)) <= 12)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.where("top").count() == 12
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "TakeOrderedAndProject" in plan
    assert mk.flag_top(df.limit(0), ["area", "part"], order, 12, "top").collect() == []


def test_dense_ids_rank_downwards(spark):
    df = spark.createDataFrame([(f"a{i:02d}", None if i == 3 else i % 7) for i in range(50)], "area string, v bigint").repartition(5)
    order = [F.desc("v"), "area"]
    want = df.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert sorted(map(str, wh.dense_ids(df, order, "rank").collect())) == sorted(map(str, want.collect()))
