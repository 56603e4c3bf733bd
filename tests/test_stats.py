"""The skew-safe exact quantile equals Spark's exact percentile, including a
hot group."""

import pytest
from pyspark.sql import functions as F

from lotmarket.operators import stats
from lotmarket.operators.stats import group_quantiles


def _skewed(spark, n=60000):
    # group 'hot' holds ~2/3 of the rows, values with ties and NULLs
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("g"),
        F.when(F.col("id") % 97 == 0, F.lit(None)).otherwise(
            (F.pmod(F.xxhash64("id"), F.lit(100000)) / 7.0)).alias("v"))
    return df


def _as_dict(df, key, cols):
    return {r[key]: tuple(round(r[c], 9) if r[c] is not None else None for c in cols) for r in df.collect()}


def test_counted_matches_exact_on_hot_group(spark):
    df = _skewed(spark)
    probs = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q99": 0.99, "q0": 0.0, "q1": 1.0}
    exact = group_quantiles(df, "g", "v", probs, method="exact")
    br = group_quantiles(df, "g", "v", probs, method="counted")
    assert _as_dict(br, "g", list(probs)) == _as_dict(exact, "g", list(probs))


def test_counted_global_and_small_groups(spark):
    df = _skewed(spark, 5000).withColumn("g2", (F.col("v") % 7).cast("int"))
    probs = {"m": 0.5, "p9": 0.9}
    a = group_quantiles(df, None, "v", probs, method="exact").first()
    b = group_quantiles(df, None, "v", probs, method="counted").first()
    assert round(a.m, 9) == round(b.m, 9) and round(a.p9, 9) == round(b.p9, 9)
    e = group_quantiles(df, "g2", "v", probs, method="exact")
    f = group_quantiles(df, "g2", "v", probs, method="counted")
    assert _as_dict(e, "g2", list(probs)) == _as_dict(f, "g2", list(probs))


def test_all_null_group_absent(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("b", 3.0)], "g string, v double")
    out = {r.g: r.m for r in group_quantiles(df, "g", "v", {"m": 0.5}).collect()}
    assert out == {"b": 2.0}


def test_values_of_all_magnitudes(spark):
    rows = [(g, s * m * 10.0 ** e) for g in "ab" for s in (-1, 1) for e in range(-30, 31, 3) for m in (1.0, 1.0, 1.00001, 7.5)]
    rows += [("a", 0.0), ("a", -0.0), ("b", 5e-324), ("b", 1.7e308), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {f"q{i}": i / 16 for i in range(17)}
    for keys in ("g", None):
        exact = [tuple(r) for r in group_quantiles(df, keys, "v", probs, method="exact").collect()]
        got = [tuple(r) for r in group_quantiles(df, keys, "v", probs).collect()]
        for x, y in zip(sorted(got), sorted(exact), strict=True):
            assert [*x] == pytest.approx([*y], rel=1e-9) if keys is None else x[0] == y[0] and [*x[1:]] == pytest.approx([*y[1:]], rel=1e-9)


def test_second_pass_shuffles_few_rows(spark):
    """On unique values pass 2 keeps under 2 percent of the rows, and only they are dealt by group and value."""
    n = 400_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("g"), (900 + F.rand(5) * 100_000).alias("_v"),
                               F.lit(1).cast("long").alias("_t"))
    binned = df.withColumn("_b", stats._bin(F.col("_v")))
    bins, n_bins = stats.wanted_bins(binned, ["g"], {"m": 0.5, "q": 0.9})
    assert 2 <= n_bins <= 8
    assert 0 < stats.values_near(binned, ["g"], bins, n_bins).agg(F.sum("_c")).first()[0] < 0.02 * n
    plan = group_quantiles(df, "g", "_v", {"m": 0.5})._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "percentile" not in plan and "SortMergeJoin" not in plan
    assert plan.rindex("Exchange hashpartitioning(") < plan.index("BroadcastHashJoin"), "no exchange below the join with the wanted bins"


def test_many_groups_meet_their_bins_by_a_join(spark, monkeypatch):
    monkeypatch.setattr(stats, "BROADCAST_ROWS", 3)
    df = _skewed(spark, 20000).withColumn("g", F.concat("g", (F.col("v") % 11).cast("int").cast("string")))
    probs = {"a": 0.1, "m": 0.5}
    out = group_quantiles(df, "g", "v", probs)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert _as_dict(out, "g", list(probs)) == _as_dict(group_quantiles(df, "g", "v", probs, method="exact"), "g", list(probs))


def test_reread_writes_only_what_a_shuffle_made(spark):
    plain = spark.range(10).where("id > 2")
    assert stats.reread(plain) is plain
    joined = plain.join(plain.withColumnRenamed("id", "x"), F.col("id") == F.col("x"))
    assert stats.reread(joined) is not joined and stats.reread(joined).count() == 7


def test_empty_frames(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert group_quantiles(df, "g", "v", {"m": 0.5}).collect() == []
    assert group_quantiles(df.join(df.withColumnRenamed("v", "w"), "g"), "g", "v", {"m": 0.5}, with_n="n").collect() == []
    none = spark.range(4).select(F.lit("a").alias("g"), F.lit(None).cast("double").alias("v"))
    assert group_quantiles(none, "g", "v", {"m": 0.5}).collect() == [] and group_quantiles(none, None, "v", {"m": 0.5}).collect() == []
