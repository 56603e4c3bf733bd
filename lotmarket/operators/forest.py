"""A random forest from drawn cells: a library fit keeps a count for each row and tree and sends every node's
histograms from every task, which fills the disks; here what travels is bounded by the cells.

1. Features are binned at exact quantiles, as in ``boost``, and rows are dealt by cell (a crowded cell by target as well);
2. each row's bootstrap count (Poisson, mean 1) is drawn for every tree where the row lies, and counts and drawn targets
   are summed per cell: at most trees times :data:`boost.MAX_CELLS` entries, whatever the number of rows;
3. a tree's entries meet in one task, which grows it on the grid, a third of the features (rounded up) drawn at each node.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmarket.operators import boost
from lotmarket.operators.stats import reread

#: Rows of a drawing task, and of one part of a crowded cell.
ROWS_PER_TASK = 200_000
#: Drawn entries a task holds before it sends them on.
HELD = 4_000_000


class Forest:
    """Trees as arrays [tree, node], see :class:`boost.Boosted`; the gains are [tree, feature]."""

    def __init__(self, feature: np.ndarray, cut: np.ndarray, value: np.ndarray, gain: np.ndarray, bounds: list[list[float]]):
        self.feature, self.cut, self.value, self.gain, self.bounds = feature, cut, value, gain, bounds

    @property
    def featureImportances(self):  # noqa: N802 - the library's name
        """Mean over the trees of each feature's share of the tree's gain."""
        from pyspark.ml.linalg import Vectors
        total = self.gain.sum(1, keepdims=True)
        share = np.divide(self.gain, total, out=np.zeros_like(self.gain), where=total > 0).sum(0)
        return Vectors.dense(share / share.sum() if share.sum() else share)

    def transform(self, df: DataFrame, features: str = "features", name: str = "prediction") -> DataFrame:
        """``df`` with the trees' mean for each row's vector."""
        from pyspark.ml.functions import vector_to_array
        table = np.zeros(boost.grid_shape(self.bounds))
        for f, c, v in zip(self.feature, self.cut, self.value, strict=True):
            boost.paint(table, f, c, v)
        xs = [f"__x{i}" for i in range(len(self.bounds))]
        wide = df.select(*[c for c in df.columns if c != name], *[vector_to_array(features)[i].alias(x) for i, x in enumerate(xs)])
        model = boost.Boosted(0.0, self.feature[:0], self.cut[:0], self.value[:0], self.gain[0], self.bounds, table / len(self.feature))
        return boost.predict_boosted(wide, model, xs, name).drop(*xs)


def drawn_cells(rows: DataFrame, trees: int, seed: int) -> DataFrame:
    """(``tree``, ``cell``, ``w``, ``s`` packed): the bootstrap counts of ``rows`` (``cell``, ``y``) and their drawn targets,
    summed by tree and cell; entries of one cell may come from several tasks."""
    from lotmarket.operators.ml import POISSON1_BOUNDS
    counts = rows.groupBy("cell").agg(F.count("*").alias("n"))
    total = rows.count()
    crowded = counts.where(F.col("n") > ROWS_PER_TASK).select("cell", F.ceil(F.col("n") / ROWS_PER_TASK).alias("k"))  # few by their size
    salt = F.coalesce(F.pmod(F.xxhash64("y"), F.col("k")), F.lit(0).cast("bigint"))
    dealt = rows.join(F.broadcast(crowded), "cell", "left").select("cell", "y", salt.alias("salt")) \
        .repartition(max(2, -(-total // ROWS_PER_TASK)), "cell", "salt").sortWithinPartitions("cell", "y").select("cell", "y")
    times = np.searchsorted(np.array(POISSON1_BOUNDS), np.arange(1 << 16), side="right").astype(np.int32)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])  # rows come in one order: the same draws
        held: list[tuple] = []

        def packed() -> pa.RecordBatch:
            out = []
            for t in range(trees):
                own = [(c[w[t] > 0], w[t][w[t] > 0], s[t][w[t] > 0]) for c, w, s in held]
                out.append((t, *[np.concatenate(part).tobytes() for part in zip(*own, strict=True)]))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), (pa.int32(), *[pa.binary()] * 3), strict=True)],
                                              names=["tree", "cell", "w", "s"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cell, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            first = np.flatnonzero(np.r_[True, np.diff(cell) != 0])
            n = times[rng.integers(0, 1 << 16, (trees, len(cell)), np.uint16)]
            held.append((cell[first].astype(np.int32), np.add.reduceat(n, first, axis=1, dtype=np.int32), np.add.reduceat(n * y, first, axis=1)))
            if sum(w.size for _, w, _ in held) > HELD:
                yield packed()
        if held:
            yield packed()

    return dealt.mapInArrow(draw, "tree int, cell binary, w binary, s binary")


def fit_forest(df: DataFrame, y: str, xs: Sequence[str], numTrees: int = 20, maxDepth: int = 5, maxBins: int = 32,  # noqa: N803 - the library's names
               minInstancesPerNode: int = 1, seed: int = 42) -> Forest:  # noqa: N803
    """Regression trees on bootstrap draws of all rows.  A NULL or NaN target and a NULL, NaN or infinite feature are
    errors, as in the library."""
    trees, depth = numTrees, maxDepth
    if maxBins ** len(xs) > boost.MAX_CELLS:
        raise ValueError(f"{maxBins} bins of {len(xs)} features make more than {boost.MAX_CELLS} cells: take fewer bins")
    df = reread(df.select(y, *xs))
    bounds = boost.bin_bounds(df, xs, maxBins)
    shape = boost.grid_shape(bounds)
    cells, k = int(np.prod(shape)), len(xs)
    cell = F.lit(0)
    for x, b in reversed(list(zip(xs, bounds, strict=True))):
        v = F.coalesce(F.col(x).cast("double"), F.lit(float("nan")))
        odd = F.isnan(v) | (F.abs(v) == float("inf"))
        v = F.when(odd, F.raise_error(F.lit("Vector values MUST NOT be NaN or Infinity")).cast("double")).otherwise(v)
        cell = cell * (len(b) + 1) + boost.bin_of(v, b)
    target = F.col(y).cast("double")
    known = F.when(target.isNull() | F.isnan(target), F.raise_error(F.lit("Labels MUST NOT be Null or NaN")).cast("double")).otherwise(target)
    drawn = drawn_cells(df.select(cell.cast("int").alias("cell"), known.alias("y")), trees, seed)
    picked = k if trees == 1 else -(-k // 3)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(t: int, grid: np.ndarray) -> pa.RecordBatch:
            made = boost.grow_grid(grid, depth, float(minInstancesPerNode), picked, np.random.default_rng([seed, trees, t]))
            used = np.flatnonzero(made[0] >= 0)
            last = int(used[-1]) * 2 + 3 if len(used) else 1  # nodes beyond are not reached
            return pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), *[pa.array([a[:last].tobytes()], pa.binary()) for a in made[:3]],
                                               pa.array([made[3].tolist()])], names=["tree", "feature", "cut", "value", "gain"])

        at, grid = -1, np.zeros(0)
        for batch in batches:
            for t, c, w, s in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if t != at:
                    if at >= 0:
                        yield done(at, grid)
                    at, grid = t, np.zeros((2, *shape))
                for i, part in enumerate((np.frombuffer(w, np.int32), np.frombuffer(s, np.float64))):
                    np.add.at(grid[i].reshape(-1), np.frombuffer(c, np.int32), part)
        if at >= 0:
            yield done(at, grid)

    grown = drawn.repartition(trees, "tree").sortWithinPartitions("tree").mapInArrow(
        train, "tree int, feature binary, cut binary, value binary, gain array<double>").collect()
    if not grown:
        raise ValueError("no rows")
    size = 2 ** (depth + 1) - 1
    arrays = [np.full((trees, size), -1, np.int8), np.zeros((trees, size), np.int16), np.zeros((trees, size))]
    gain = np.zeros((trees, k))
    for r in grown:
        for a, name in zip(arrays, ("feature", "cut", "value"), strict=True):
            got = np.frombuffer(r[name], a.dtype)
            a[r["tree"], :len(got)] = got
        gain[r["tree"]] = r["gain"]
    return Forest(*arrays, gain, bounds)
