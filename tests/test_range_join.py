"""The grid join against every pair, with boxes of all sizes."""

import random

import pytest
from pyspark.sql import functions as F

from lotmarket.operators import relational as rel

BOX = "name string, south double, west double, north double, east double"


def case(n_boxes, seed):
    rng = random.Random(seed)
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(400)] + [(400, None, 1.0), (401, 1.0, None), (402, 10.0, 20.0)]
    boxes = []
    for i in range(n_boxes):
        y, x, r = rng.uniform(-90, 90), rng.uniform(-180, 180), rng.choice([0.0, 0.5, 3.0, 40.0])
        boxes.append((f"b{i}", y - r, x - r, y + r, x + r))
    boxes += [("world", -90.0, -180.0, 90.0, 180.0), ("none", None, 0.0, 1.0, 1.0), ("inside out", 5.0, 0.0, -5.0, 1.0), ("edge", 10.0, 20.0, 10.0, 20.0)]
    return points, boxes


def every_pair(points, boxes):
    return sorted((i, n) for i, y, x in points for n, s, w, no, e in boxes
                  if None not in (y, x, s, w, no, e) and s <= y <= no and w <= x <= e)


@pytest.mark.parametrize("cell,max_cells", [(None, 10_000), (1.0, 50), ((0.7, 90.0), 4), (500.0, 10)])
def test_against_every_pair(spark, cell, max_cells):
    points, boxes = case(150, 4)
    out = rel.range_join(spark.createDataFrame(points, "id long, lat double, lon double"), spark.createDataFrame(boxes, BOX), "lat", "lon", cell, max_cells=max_cells)
    assert sorted((r["id"], r["name"]) for r in out.collect()) == every_pair(points, boxes)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_many_boxes_meet_by_a_salted_join(spark, monkeypatch):
    monkeypatch.setattr(rel, "BROADCAST_ROWS", 3)
    points, boxes = case(60, 7)
    out = rel.range_join(spark.createDataFrame(points, "id long, lat double, lon double"), spark.createDataFrame(boxes, BOX), "lat", "lon", 20.0)
    assert sorted((r["id"], r["name"]) for r in out.collect()) == every_pair(points, boxes)


def test_salted_copies_are_never_broadcast(spark, monkeypatch):
    """The copies of many boxes come from a small file: by its size alone Spark would send them all through the driver."""
    from lotmarket.operators import common
    monkeypatch.setattr(rel, "BROADCAST_ROWS", 3)
    points, boxes = case(60, 7)
    out = rel.range_join(spark.createDataFrame(points, "id long, lat double, lon double"), spark.createDataFrame(boxes, BOX), "lat", "lon", 20.0)
    small = spark.createDataFrame([(i, i * 10) for i in range(9)], "k long, v long")
    joined = common.join_small(spark.range(100).withColumn("k", F.col("id") % 12), small, ["k"], bound=3)
    for df in (out, joined):
        rows = sorted(tuple(r) for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert rows and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert [r[2] for r in sorted(joined.select("id", "k", "v").collect())][:12] == [*range(0, 90, 10), None, None, None]


def test_empty_sides(spark):
    points, boxes = case(3, 1)
    p, b = spark.createDataFrame(points, "id long, lat double, lon double"), spark.createDataFrame(boxes, BOX)
    assert rel.range_join(p.limit(0), b, "lat", "lon").count() == 0 and rel.range_join(p, b.limit(0), "lat", "lon").count() == 0
    with pytest.raises(ValueError, match="both sides"):
        rel.range_join(p.withColumnRenamed("id", "name"), b, "lat", "lon")


def test_first_row_of_a_key_is_inserted(spark):
    target = spark.createDataFrame([(1, "a", 5)], "k long, v string, n long")
    new = spark.createDataFrame([(2, "z", 1), (2, "b", 9), (1, "c", 0), (3, None, 2), (2, "b", 3)], "k long, v string, n long")
    got = sorted(tuple(r) for r in rel.insert_or_ignore(target, new, "k").collect())
    assert got == [(1, "a", 5), (2, "b", 3), (3, None, 2)]
    assert sorted(r[2] for r in rel.insert_or_ignore(target, new, "k", ["n"]).collect()) == [1, 2, 5]
