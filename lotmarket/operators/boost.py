"""Boosted regression trees from a table of cells.

With squared error and binned features, rows of one combination of bins are one row: a tree's splits and leaf values
depend on each cell's weight and sum alone, in every round.  So the rows are read once:

1. split candidates are exact quantiles of each feature (two passes, see ``stats``);
2. one aggregate, combined in each task, sums weight and target per cell: ``bins ** features`` cells at most, whatever
   the number of rows; :data:`MAX_CELLS` bounds that by construction;
3. the trees are grown from this bounded table in one task, level by level, on the grid of all combinations of bins: a
   node is a box of it, so its histograms are sums over a part (sparse tables keep a list of cells).  500 rounds then cost
   no further pass over the rows, where a library fit runs some twenty Spark stages a round;
4. rows are scored where they lie, with the fitted trees (a table bounded by rounds and depth) or their sum over the grid
   sent along.

``subsample`` thins each cell's weight by a binomial draw, which is what drawing its rows would give its count; the drawn
rows' mean is taken to be the cell's.  A NULL or NaN target drops the row; a NULL feature is below all bounds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotmarket.operators.stats import column_quantiles, reread

#: Most cells a table may have; bins to the power of the number of features must not exceed it.
MAX_CELLS = 1 << 20
#: Trees are grown on the grid of all combinations where more than one of as many is occupied, else from the list of cells.
DENSE = 20
#: Rows of a task up to which each is scored by itself; beyond, the trees are added up over the grid.
SINGLE_ROWS = 20_000


class Boosted(NamedTuple):
    """Trees as arrays [tree, node]; the children of node i are 2i + 1 (bin up to ``cut``) and 2i + 2."""

    base: float
    feature: np.ndarray  # -1: a leaf
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray  # summed by feature
    bounds: list[list[float]]
    table: np.ndarray | None = None  # the value of each combination of bins, where the fit has made it

    def importances(self) -> list[float]:
        total = self.gain.sum()
        return (self.gain / total if total else self.gain).tolist()


def bin_bounds(df: DataFrame, xs: Sequence[str], bins: int) -> list[list[float]]:
    """Distinct inner quantiles of each feature: at most ``bins - 1`` bounds, so at most ``bins`` bins."""
    names = {f"q{i}": i / bins for i in range(1, bins)}
    row = column_quantiles(df, xs, names).first()
    return [sorted({row[f"{n}__{x}"] for n in names if row[f"{n}__{x}"] is not None}) for x in xs]


def bin_of(x: Column, bounds: Sequence[float]) -> Column:
    """How many bounds a value is above; 0 for NULL."""
    if not bounds:
        return F.lit(0)
    v = x.cast("double")
    return F.when(v.isNull(), 0).otherwise(F.size(F.filter(F.lit([float(b) for b in bounds]), lambda b: v > b)))


def cell_table(df: DataFrame, y: str, xs: Sequence[str], bounds: Sequence[Sequence[float]], weight: str | None = None) -> DataFrame:
    """(``b0`` .. , ``w``, ``s``): weight and weighted sum of the target for each occupied combination of bins."""
    w = (F.col(weight) if weight else F.lit(1)).cast("double")
    rows = df.where(F.col(y).isNotNull() & ~F.isnan(F.col(y).cast("double")))
    rows = rows.select(*[bin_of(F.col(x), b).alias(f"b{i}") for i, (x, b) in enumerate(zip(xs, bounds, strict=True))],
                       w.alias("w"), (w * F.col(y).cast("double")).alias("s"))
    return rows.groupBy(*[f"b{i}" for i in range(len(xs))]).agg(F.sum("w").alias("w"), F.sum("s").alias("s"))


Box = tuple[slice, ...]  #: a node's ranges of bins; the axes of a grid are the features in reverse


def grid_shape(bounds: Sequence[Sequence[float]]) -> tuple[int, ...]:
    """The grid of all combinations of bins; its flat order is that of ``np.lexsort`` on the features."""
    return tuple(len(b) + 1 for b in reversed(bounds))


def slots(bins: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """Each row of bins as its place in the flat grid."""
    return np.ravel_multi_index(tuple(bins[:, ::-1].T), shape)


def marginals(part: np.ndarray) -> list[np.ndarray]:
    """Sums of a C-ordered array along each axis but the first, over all others: two passes whatever their number."""
    k = part.ndim - 1
    if k == 1:
        return [part]
    low, high = part.shape[1:1 + k // 2], part.shape[1 + k // 2:]
    flat = part.reshape(len(part), int(np.prod(low)), -1)
    return marginals(flat.sum(2).reshape(-1, *low)) + marginals(flat.sum(1).reshape(-1, *high))


def halves(box: Box, axis: int, cut: int) -> tuple[Box, Box]:
    a, b = box[axis].start, box[axis].stop
    return (*box[:axis], slice(a, cut + 1), *box[axis + 1:]), (*box[:axis], slice(cut + 1, b), *box[axis + 1:])


def grow_grid(grid: np.ndarray, depth: int, min_rows: float, picked: int | None = None, rng: np.random.Generator | None = None) -> tuple[np.ndarray, ...]:
    """One tree on a grid [weight and sum, bins of the last feature, .., of the first]: (feature, cut, value, gain by
    feature).  A node is a box of the grid, so its histograms are sums of a part of it and no cell is looked up by its node.
    With ``picked``, each node chooses among as many features, drawn by ``rng``."""
    size, k, widest = 2 ** (depth + 1) - 1, grid.ndim - 1, max(grid.shape[1:])
    feature, cut, value, gains = np.full(size, -1, np.int8), np.zeros(size, np.int16), np.zeros(size), np.zeros(k)
    boxes: dict[int, Box] = {0: tuple(slice(0, n) for n in grid.shape[1:])}
    parts = [grid]
    for level in range(depth + 1):
        nodes = np.fromiter(boxes, np.int64, len(boxes))
        if level == depth:
            weight, total = np.array([part.reshape(2, -1).sum(1) for part in parts]).T
            value[nodes] = np.divide(total, weight, out=np.zeros(len(nodes)), where=weight > 0)
            break
        hist = np.zeros((2, len(nodes), k, widest))
        for i, (box, part) in enumerate(zip(boxes.values(), parts, strict=True)):
            for axis, h in enumerate(marginals(part)):
                hist[:, i, k - 1 - axis, box[axis]] = h
        weight, total = hist[:, :, 0].sum(-1)
        value[nodes] = np.divide(total, weight, out=np.zeros(len(nodes)), where=weight > 0)
        if widest == 1:
            break
        left_w, left_s = hist[..., :-1].cumsum(-1)
        right_w, right_s = weight[:, None, None] - left_w, total[:, None, None] - left_s
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_s**2 / left_w + right_s**2 / right_w - (total**2 / weight)[:, None, None]
        gain = np.where((left_w >= min_rows) & (right_w >= min_rows), gain, 0.0)
        if picked is not None:
            gain[rng.random((len(nodes), k)).argsort(1).argsort(1) >= picked] = 0.0
        best, best_feature, best_cut = np.zeros(len(nodes)), np.full(len(nodes), -1), np.zeros(len(nodes), np.int64)
        for f in range(k):
            c = gain[:, f].argmax(1)
            top = gain[np.arange(len(nodes)), f, c]
            new = top > best + 1e-12
            best, best_feature, best_cut = np.where(new, top, best), np.where(new, f, best_feature), np.where(new, c, best_cut)
        feature[nodes], cut[nodes] = best_feature, best_cut
        split = best_feature >= 0
        np.add.at(gains, best_feature[split], best[split])
        below: dict[int, Box] = {}
        pieces = []
        for node, box, part, f, c in zip(boxes, boxes.values(), parts, best_feature.tolist(), best_cut.tolist(), strict=True):
            if f >= 0:
                axis = k - 1 - f
                below[2 * node + 1], below[2 * node + 2] = halves(box, axis, c)
                pieces += [np.ascontiguousarray(x) for x in np.split(part, [c + 1 - box[axis].start], axis + 1)]
        if not below:
            break
        boxes, parts = below, pieces
    return feature, cut, value, gains


def grow(bins: np.ndarray, w: np.ndarray, r: np.ndarray, n_bins: int, depth: int, min_rows: float) -> tuple[np.ndarray, ...]:
    """One tree on cells with bins [cell, feature], weights and mean residuals: (feature, cut, value, gain by feature)."""
    size, k = 2 ** (depth + 1) - 1, bins.shape[1]
    feature, cut, value, gains = np.full(size, -1, np.int8), np.zeros(size, np.int16), np.zeros(size), np.zeros(k)
    node, wr, first = np.zeros(len(w), np.int64), w * r, 0
    for level in range(depth + 1):
        count = 2**level
        held = node >= first  # cells of nodes that were split on the level above
        at = node[held] - first
        weight, total = np.bincount(at, w[held], count), np.bincount(at, wr[held], count)
        with np.errstate(divide="ignore", invalid="ignore"):
            value[first:first + count] = np.where(weight > 0, total / weight, 0.0)
            if level == depth:
                break
            best, best_feature, best_cut = np.zeros(count), np.full(count, -1), np.zeros(count, np.int64)
            for f in range(k):
                slot = at * n_bins + bins[held, f]
                left_w = np.bincount(slot, w[held], count * n_bins).reshape(count, n_bins).cumsum(1)[:, :-1]
                left_s = np.bincount(slot, wr[held], count * n_bins).reshape(count, n_bins).cumsum(1)[:, :-1]
                right_w, right_s = weight[:, None] - left_w, total[:, None] - left_s
                gain = left_s**2 / left_w + right_s**2 / right_w - (total**2 / weight)[:, None]
                gain = np.where((left_w >= min_rows) & (right_w >= min_rows), gain, 0.0)
                if gain.shape[1]:
                    c = gain.argmax(1)
                    top = gain[np.arange(count), c]
                    new = top > best + 1e-12
                    best, best_feature, best_cut = np.where(new, top, best), np.where(new, f, best_feature), np.where(new, c, best_cut)
        feature[first:first + count], cut[first:first + count] = best_feature, best_cut
        split = best_feature >= 0
        np.add.at(gains, best_feature[split], best[split])
        cells = np.flatnonzero(held)[split[at]]
        mine = node[cells]
        node[cells] = 2 * mine + 1 + (bins[cells, feature[mine]] > cut[mine])
        first += count
    return feature, cut, value, gains


def leaf_values(model: Boosted, tree: int, bins: np.ndarray) -> np.ndarray:
    """The value of the leaf that each row of bins reaches in one tree."""
    node = np.zeros(len(bins), np.int64)
    while True:
        f = model.feature[tree][node]
        go = np.flatnonzero(f >= 0)
        if not len(go):
            return model.value[tree][node]
        node[go] = 2 * node[go] + 1 + (bins[go, f[go]] > model.cut[tree][node[go]])


def paint(table: np.ndarray, feature: np.ndarray, cut: np.ndarray, value: np.ndarray) -> None:
    """Add one tree's values to a table over the grid."""
    f, c, v, k = feature.tolist(), cut.tolist(), value.tolist(), table.ndim
    left: list[tuple[int, Box]] = [(0, tuple(slice(0, n) for n in table.shape))]
    while left:
        node, box = left.pop()
        if f[node] < 0:
            table[box] += v[node]
        else:
            low, high = halves(box, k - 1 - f[node], c[node])
            left += [(2 * node + 1, low), (2 * node + 2, high)]


def boost(bins: np.ndarray, w: np.ndarray, s: np.ndarray, rounds: int, depth: int, step: float, subsample: float, seed: int,
          bounds: list[list[float]], min_rows: float = 1.0) -> Boosted:
    """``rounds`` trees on a table of cells."""
    order = np.lexsort(bins.T)  # the same trees whatever the order in which the cells come
    bins, w, mean = bins[order], w[order], (s / w)[order]
    rng, shape = np.random.default_rng(seed), grid_shape(bounds)
    at, cells = slots(bins, shape), int(np.prod(shape))
    size = 2 ** (depth + 1) - 1
    model = Boosted(float(np.average(mean, weights=w)), np.full((rounds, size), -1, np.int8), np.zeros((rounds, size), np.int16),
                    np.zeros((rounds, size)), np.zeros(bins.shape[1]), bounds)
    dense = len(w) * DENSE > cells
    fitted = np.full(shape if dense else len(w), model.base)
    count, grid = np.rint(w).astype(np.int64), np.zeros((2, *shape) if dense else 0)
    for t in range(rounds):
        drawn = w if subsample >= 1 else rng.binomial(count, subsample).astype(float)
        if dense:
            for i, v in enumerate((drawn, drawn * (mean - fitted.ravel()[at]))):
                grid[i] = np.bincount(at, v, cells).reshape(shape)
            feature, cut, value, gains = grow_grid(grid, depth, min_rows)
        else:
            use = drawn > 0
            feature, cut, value, gains = grow(bins[use], drawn[use], (mean - fitted)[use], max(shape), depth, min_rows)
        model.feature[t], model.cut[t], model.value[t] = feature, cut, step * value
        model.gain[:] += gains
        if dense:
            paint(fitted, feature, cut, step * value)
        else:
            fitted += leaf_values(model, t, bins)
    return model._replace(table=fitted) if dense else model


def fit_boosted(df: DataFrame, y: str, xs: Sequence[str], rounds: int = 500, depth: int = 7, step: float = 0.05, subsample: float = 0.8,
                bins: int = 32, seed: int = 42, weight: str | None = None) -> Boosted:
    """Boosted trees for ``y`` by ``xs``."""
    if bins ** len(xs) > MAX_CELLS:
        raise ValueError(f"{bins} bins of {len(xs)} features make more than {MAX_CELLS} cells: take fewer bins")
    df = reread(df.select(y, *xs, *([weight] if weight else [])))
    bounds = bin_bounds(df, xs, bins)
    k = len(xs)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        cells = pa.Table.from_batches(parts)
        at = np.stack([cells.column(f"b{i}").to_numpy() for i in range(k)], axis=1).astype(np.int64)
        m = boost(at, cells.column("w").to_numpy(), cells.column("s").to_numpy(), rounds, depth, step, subsample, seed, bounds)
        arrays = [m.feature, m.cut, m.value, np.zeros(0) if m.table is None else m.table]
        yield pa.RecordBatch.from_arrays([pa.array([m.base]), pa.array([m.gain.tolist()]), *[pa.array([a.tobytes()], pa.binary()) for a in arrays]],
                                         names=["base", "gain", "feature", "cut", "value", "grid"])

    made = cell_table(df, y, xs, bounds, weight).coalesce(1).mapInArrow(
        train, "base double, gain array<double>, feature binary, cut binary, value binary, grid binary").collect()
    if not made:
        raise ValueError("no rows with a target")
    r = made[0]
    size = 2 ** (depth + 1) - 1
    of = lambda name, kind: np.frombuffer(r[name], kind).reshape(rounds, size)
    return Boosted(r["base"], of("feature", np.int8), of("cut", np.int16), of("value", np.float64), np.array(r["gain"]), bounds,
                   np.frombuffer(r["grid"], np.float64).reshape(grid_shape(bounds)) if r["grid"] else None)


def predict_boosted(df: DataFrame, model: Boosted, xs: Sequence[str], name: str = "prediction") -> DataFrame:
    """``df`` with the model's value for each row."""
    keep = [c for c in df.columns if c != name]
    ready = df.select(*keep, *[bin_of(F.col(x), b).alias(f"__b{i}") for i, (x, b) in enumerate(zip(xs, model.bounds, strict=True))])
    k, trees, shape = len(xs), len(model.feature), grid_shape(model.bounds)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = model.table, 0
        for batch in batches:
            bins = np.stack([batch.column(len(keep) + i).to_numpy() for i in range(k)], axis=1).astype(np.int64)
            seen += batch.num_rows
            if table is None and seen > SINGLE_ROWS:
                table = np.full(shape, model.base)
                for t in range(trees):
                    paint(table, model.feature[t], model.cut[t], model.value[t])
            if table is None:
                out = np.full(batch.num_rows, model.base)
                for t in range(trees):
                    out += leaf_values(model, t, bins)
            else:
                out = table.ravel()[slots(bins, shape)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], pa.array(out)], names=[*keep, name])

    return ready.mapInArrow(score, T.StructType([*(df.schema[c] for c in keep), T.StructField(name, T.DoubleType())]))


def importance_rows(model: Boosted, xs: Sequence[str], like: DataFrame) -> DataFrame:
    """M6: each feature's share of the gain of all splits."""
    return like.sparkSession.createDataFrame(list(zip(xs, model.importances(), strict=True)), "feature string, importance double")
