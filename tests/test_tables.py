"""Loads that are appended exactly once, sketches that merge, and prints of files."""

import hashlib

from pyspark.sql import functions as F

from lotmarket.operators import market as mk
from lotmarket.operators import ml
from lotmarket.session import scratch_path
from lotmarket.sources import files as io


def test_a_repeated_load_counts_once_and_leaves_others_alone(spark):
    path = scratch_path(spark, "loads")
    rows = lambda lo, hi: spark.range(lo, hi).select("id", (F.col("id") % 3).alias("part"))
    io.append_load(rows(0, 30), path, "a", ["part"])
    for _ in range(3):
        io.append_load(rows(30, 40), path, "b", ["part"])
    t = spark.read.parquet(path)
    assert sorted(r.id for r in t.collect()) == list(range(40))
    assert {r[0]: r[1] for r in t.groupBy("load_id").count().collect()} == {"a": 30, "b": 10}


def test_sketches_of_parts_give_the_whole(spark):
    df = spark.range(60_000).select((F.col("id") % 5).alias("part"), (F.col("id") % 20_000).alias("v"))
    parts = mk.distinct_sketches(df.withColumn("all", F.lit(1)), ["all", "part"], "v")
    merged = mk.distinct_estimate(parts, "all").first()["n_distinct"]
    whole = mk.distinct_estimate(mk.distinct_sketches(df.withColumn("all", F.lit(1)), "all", "v"), "all").first()["n_distinct"]
    assert abs(merged - 20_000) < 0.05 * 20_000 and abs(whole - merged) < 0.02 * merged
    assert mk.distinct_estimate(mk.distinct_sketches(df.where("v < 0"), "part", "v"), "part").count() == 0


def test_codes_reach_rows_by_a_broadcast(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "c string")
    out = ml.label_encode(df, "c", "code", missing="z")
    assert sorted(tuple(r) for r in out.collect()) == [("a", 0), ("b", 1), ("b", 1), ("z", 2)]
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_prints_of_files_come_from_their_ranges(spark, tmp_path):
    sizes = {"empty": 0, "one": 1, "range": 64, "more": 65, "two %20#ranges?": 128, "long": 1000, "deeper/one": 3}
    (tmp_path / "deeper").mkdir()
    for name, n in sizes.items():
        (tmp_path / name).write_bytes(bytes((i * 7 + n) % 256 for i in range(n)))
    got = {(r.file, r.bytes, r.n_ranges, r.file_print) for r in io.file_range_prints(spark, str(tmp_path / "*"), range_bytes=64).collect()}
    expected = set()
    for name, n in sizes.items():
        raw = (tmp_path / name).read_bytes()
        parts = [hashlib.sha256(raw[i:i + 64]).hexdigest() for i in range(0, n, 64)]
        if parts:  # empty files aren't listed
            expected.add((name.rpartition("/")[2], n, len(parts), hashlib.sha256("".join(parts).encode()).hexdigest()))
    assert got == expected
    one = tmp_path / "one"
    before = io.file_range_prints(spark, str(one), range_bytes=64).first()
    one.write_bytes(b"!")
    after = io.file_range_prints(spark, str(one), range_bytes=64).first()
    assert (before.file, before.bytes) == (after.file, after.bytes) and before.file_print != after.file_print


def test_file_fingerprints_in_pieces(spark, tmp_path):
    """MD5 of whole files, also of those longer than one read and with odd names."""
    for name, content in (("a b.bin", b"x" * 3_000_001), ("c%20d.bin", b"y"), ("e.bin", bytes(range(256)) * 8192)):
        (tmp_path / name).write_bytes(content)
    got = {(r.file, r.bytes, r.file_hash) for r in io.file_fingerprints(spark, str(tmp_path / "*")).collect()}
    assert {(n, h) for _, n, h in got} == {(p.stat().st_size, hashlib.md5(p.read_bytes()).hexdigest()[:16]) for p in tmp_path.iterdir()}
    assert len(got) == 3


def test_sales_by_order_has_the_rows_of_sales_in_parts_by_their_number(spark, monkeypatch):
    """A task's sorts and hash tables hold a bounded number of fact rows, whatever the session's shuffle partitions."""
    from lotmarket.operators import relational as rel
    from lotmarket.plans import binding
    d = "/root/testdata/sf0.001"
    monkeypatch.setattr(binding, "ROWS_PER_TASK", 100)
    rows = binding.sales(spark, d)
    dealt = binding.sales_by_order(spark, d)
    assert dealt.columns == rows.columns and dealt.exceptAll(rows).isEmpty() and rows.exceptAll(dealt).isEmpty()
    n = -(-binding.table(spark, d, "lineitem").count() // 100)
    plan = rel.dedup_first(rel.dedup_full(dealt), ["l_orderkey", "l_linenumber"], dealt.columns)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" in plan and f", {n}), REPARTITION_BY_NUM" in plan
    assert plan[:plan.index("SortMergeJoin [l_orderkey")].count("Exchange") == 0  # both steps lie where the join left the rows
