"""Connected components of an edge table: local forests, then alternating large and small stars, in joins and aggregates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmarket.llm.common import written

#: Edges that one task reduces to a forest.
FOREST = 1 << 19


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's edges as stars: each node with the least one that it is connected with here."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    stars = np.array([(x, find(x)) for x in root], dtype=np.int64).reshape(-1, 2)
    stars = stars[stars[:, 0] != stars[:, 1]]
    yield pa.RecordBatch.from_arrays([pa.array(stars[:, 0]), pa.array(stars[:, 1])], names=["a", "b"])


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    adjacent = _both(edges)
    least = adjacent.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return adjacent.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, is linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of the edges (a, b); the component is its smallest node.

    Tasks of at most about FOREST edges reduce theirs to stars.  If one task has them all, that is the result; else
    stars are joined until they no longer change.
    """
    now = written(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "edges")
    tasks = -(-now.count() // FOREST)
    now = written(now.repartition(max(1, tasks)).mapInArrow(_forest, "a bigint, b bigint"), "edges")
    seen = None
    while tasks > 1:
        now = written(_small_star(_large_star(now).distinct()).distinct(), "edges")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
