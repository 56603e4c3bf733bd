"""The bootstrap's sums against a plain loop, and that no row is copied for them."""

import hashlib

import pytest

from lotmarket.operators import ml

ROWS = [(k, k % 7 + 0.5 if k % 11 else None, float(k * k % 23), 3.0 * k - 40) for k in range(60)]


def weight(key, rep, seed):
    h = hashlib.sha256(f"{seed}-{rep // 16}-{key}".encode()).digest()
    draw = int.from_bytes(h[2 * (rep % 16):2 * (rep % 16) + 2], "big")
    return sum(draw >= b for b in ml.POISSON1_BOUNDS)


@pytest.mark.parametrize("xs", [["a"], ["a", "b"]])
def test_sums_of_all_replicates(spark, xs):
    reps, seed = 20, 3
    df = spark.createDataFrame(ROWS, "k long, a double, b double, y double")
    got = {r["rep"]: r.asDict() for r in ml.bootstrap_sums(df, ["k"], "y", xs, reps, seed).collect()}
    assert sorted(got) == list(range(1, reps + 1))
    for rep in range(reps):
        rows = [(weight(k, rep, seed), a, b, y) for k, a, b, y in ROWS if a is not None]
        expected = {"n": sum(r[0] for r in rows), "sy": sum(r[0] * r[3] for r in rows), "syy": sum(r[0] * r[3] ** 2 for r in rows),
                    "s1": sum(r[0] * r[1] for r in rows), "s1y": sum(r[0] * r[1] * r[3] for r in rows)}
        if len(xs) == 2:
            expected |= {"s12": sum(r[0] * r[1] * r[2] for r in rows), "s22": sum(r[0] * r[2] ** 2 for r in rows)}
        for name, value in expected.items():
            assert got[rep + 1][name] == pytest.approx(value)


def test_rows_are_not_copied(spark):
    df = spark.createDataFrame(ROWS, "k long, a double, b double, y double")
    plan = ml.bootstrap_sums(df, ["k"], "y", ["a"], 50, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_empty_training_rows(spark):
    df = spark.createDataFrame([], "k long, a double, b double, y double")
    assert all(r["n"] == 0 for r in ml.bootstrap_sums(df, ["k"], "y", ["a"], 5, 1).collect())
