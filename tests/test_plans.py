"""Plan-shape assertions: pushdown, pruning, no cartesian products."""

import pytest
from pyspark.sql import functions as F

from lotmarket.plans import catalog
from conftest import SF_SMALL


def _plan(df):
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture
def plans_of(spark, monkeypatch):
    """All plans of a key: those of the tables that are written for it, and the result's own."""
    from lotmarket.operators import stats
    from lotmarket.sources import files
    seen, whole = [], files.materialize

    def watched(df, name):
        seen.append(_plan(df))
        return whole(df, name)

    monkeypatch.setattr(files, "materialize", watched)
    monkeypatch.setattr(stats, "materialize", watched)

    def run(key):
        last = _plan(catalog.queries()[key](spark, SF_SMALL))
        return [*seen, last]
    return run


def test_price_floor_pushed_to_scan(plans_of):
    assert any("GreaterThan(l_extendedprice,10000.0)" in p for p in plans_of("median_by_region"))


def test_scan_reads_only_needed_columns(plans_of):
    # the lineitem scan reads the join keys and the price only, and once
    schemas = [line for p in plans_of("median_by_region") for line in p.split("\n") if line.strip().startswith("ReadSchema: struct<l_")]
    assert len(schemas) == 1 and all("l_discount" not in s and "l_shipdate" not in s for s in schemas)


@pytest.mark.parametrize("key", ["median_by_region", "kpi_overview", "hotspots", "neighborhood_returns", "dedup_key", "fact_build",
                                 "bbox_join", "catchment_join", "livability", "kfold_r2"])
def test_no_cartesian_product(plans_of, key):
    assert not any("CartesianProduct" in p or "NestedLoop" in p for p in plans_of(key))


@pytest.mark.parametrize("key,columns", [("target_encode", ["neighborhood"]), ("enrich_region", ["borough_name"])])
def test_rows_are_not_dealt_by_a_hot_key(spark, key, columns):
    """The rows meet a broadcast of counted size; only the (pre-aggregated) statistics are exchanged by the key."""
    plan = catalog.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    for c in columns:
        assert f"hashpartitioning({c}#" not in plan


def test_salted_join_beyond_the_bound(spark):
    from lotmarket.operators.common import join_small
    small = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    df = spark.createDataFrame([("a", i) for i in range(50)] + [("c", 50), (None, 51)], "k string, i int")
    for bound in (100, 1):
        got = sorted(((r["k"] or "", r["i"], r["v"]) for r in join_small(df, small, ["k"], bound=bound).collect()))
        assert got == [("", 51, None)] + [("a", i, 1) for i in range(50)] + [("c", 50, None)]
        assert join_small(df, small, ["k"], bound=bound, null_safe=True).where("k IS NULL").first()["v"] == 3


@pytest.mark.parametrize("key", ["star_join_bucketed", "order_baskets"])
def test_laid_out_tables_are_joined_where_they_lie(spark, key):
    """Neither side is exchanged, though both are too big to broadcast, and nothing is left in the catalog."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = {t.name for t in spark.catalog.listTables()}
        df = catalog.queries()[key](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert df.count() > 0  # the files outlive their catalog entry
        assert {t.name for t in spark.catalog.listTables()} == before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_named_layout_is_found_by_its_name(spark):
    from lotmarket.sources.files import bucketed
    rows = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    for n in (2, 3):  # the second layout replaces the first
        bucketed(rows, ["k"], "named", buckets=n, table="layout_of_test")
    try:
        t = spark.table("layout_of_test")
        assert t.count() == 1000 and t.rdd.getNumPartitions() == 3
        assert "Exchange" not in t.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql("DROP TABLE layout_of_test")
