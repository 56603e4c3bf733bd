"""Joins, set operations and de-duplication.

Skew notes: key de-duplication is an aggregate (``min_by`` over a struct), so
rows of a hot key are combined map-side before the shuffle instead of being
sorted in one window task.  Joins never force a broadcast of data-sized
frames; only code-defined parameter tables are hinted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotmarket.operators.common import BROADCAST_ROWS, SALTS
from lotmarket.sources.files import materialize_counted


def _ks(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; missing columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def dedup_full(df: DataFrame) -> DataFrame:
    """U4: drop exact duplicate rows."""
    return df.dropDuplicates()


def dedup_first(df: DataFrame, keys, order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per business key under an explicit total order.

    A ``min_by(struct(row), struct(order))`` aggregate: each task sorts its rows by key (structs
    have no hash aggregate) and sends one row per key, so a key with a third of the rows costs
    one row per map task, not one sorted partition.
    """
    ks = _ks(keys)
    rest = [c for c in df.columns if c not in ks]
    ord_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    packed = df.groupBy(*ks).agg(
        F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*ord_cols)).alias("_row"))
    return packed.select(*ks, *[F.col(f"_row.{c}").alias(c) for c in rest])


def dup_count(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier identical row."""
    from lotmarket.operators.common import attach
    total = df.agg(F.count("*").alias("_n"))
    distinct = df.dropDuplicates().agg(F.count("*").alias("_d"))
    return attach(total, distinct).select((F.col("_n") - F.col("_d")).cast("bigint").alias("duplicate_rows"))


def insert_or_ignore(target: DataFrame, incoming: DataFrame, keys, order: Sequence[Column | str] | None = None) -> DataFrame:
    """Rows of ``incoming`` whose key is new, appended to ``target``; of several with one key the first in ``order``
    (all other columns unless given), so which row stays is no matter of chance."""
    ks = _ks(keys)
    rest = [c for c in incoming.columns if c not in ks]
    new = dedup_first(incoming, ks, order or rest or ks) if rest else incoming.dropDuplicates()
    return target.unionByName(new.join(target.select(*ks), ks, "left_anti"))


def orphan_count(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Number of child rows whose FK is absent from the parent."""
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return child.join(p, F.col(child_key) == F.col("_pk"), "left_anti").agg(
        F.count("*").cast("bigint").alias("orphans"))


def resolve_fk(df: DataFrame, dim: DataFrame, on: Mapping[str, str], id_col: str, default) -> DataFrame:
    """Look up a surrogate id on a composite natural key, default when absent.

    ``on`` maps fact columns to dimension columns.
    """
    d = dim.select(*[F.col(v).alias(f"_d_{k}") for k, v in on.items()], F.col(id_col).alias("_id"))
    cond = None
    for k in on:
        c = F.col(k) == F.col(f"_d_{k}")
        cond = c if cond is None else cond & c
    j = df.join(d, cond, "left")
    return j.select(*df.columns, F.coalesce(F.col("_id"), F.lit(default)).alias(id_col))


def upsert_attributes(base: DataFrame, updates: DataFrame, keys, cols: Sequence[str]) -> DataFrame:
    """Update matched rows only: ``coalesce(new, old)`` per attribute."""
    ks = _ks(keys)
    u = updates.select(*ks, *[F.col(c).alias(f"_new_{c}") for c in cols])
    j = base.join(u, ks, "left")
    out = [F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in cols else F.col(c) for c in base.columns]
    return j.select(*out)


def reconcile_groups(a: DataFrame, b: DataFrame, key: str, value: str, tol: float = 1.0) -> DataFrame:
    """Full outer join of two per-group values; ok when both present and
    ``|a - b| < tol``."""
    x = a.select(F.col(key), F.col(value).alias("value_a"))
    y = b.select(F.col(key), F.col(value).alias("value_b"))
    j = x.join(y, key, "full")
    return j.withColumn("diff", F.col("value_a") - F.col("value_b")).withColumn(
        "ok", F.coalesce(F.abs(F.col("diff")) < tol, F.lit(False)))


def semi_top_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows whose ``key`` is among the ``n`` most frequent (ties by key).

    The top-n list is at most ``n`` rows, so it is broadcast.
    """
    top = df.groupBy(key).agg(F.count("*").alias("_c")).orderBy(F.desc("_c"), F.asc(key)).limit(n)
    return df.join(F.broadcast(top.select(key)), key, "left_semi")


def range_join(points: DataFrame, boxes: DataFrame, lat: str, lon: str, cell: float | tuple[float, float] | None = None,
               bounds: Sequence[str] = ("south", "west", "north", "east"), max_cells: int = 10_000) -> DataFrame:
    """Each point with each box that holds it (edges included), for any number of possibly overlapping boxes.

    Both sides get cells of a grid: a point its own, a box all that it touches.  They are joined by cell, an ordinary
    equi-join, and tested exactly after it, so a point meets only the boxes near it, and never twice (it has one cell).
    ``cell`` is the cells' size (height, width); by default the boxes' mean extent, so that a box touches a few cells.  A
    box of more than ``max_cells`` cells is put into the next coarser grid of twice the size until it fits; a point looks
    each grid in use up.  NULL coordinates or bounds match nothing.

    The boxes' cells are written and counted: up to ``BROADCAST_ROWS`` they are broadcast and the points aren't shuffled;
    beyond, a cell's points are dealt over ``SALTS`` tasks with the boxes copied to each, so a crowded cell is split.
    """
    south, west, north, east = bounds
    taken = [c for c in boxes.columns if c in points.columns]
    if taken:
        raise ValueError(f"columns on both sides: {taken}")
    whole = boxes.where((F.col(south) <= F.col(north)) & (F.col(west) <= F.col(east)))
    if cell is None:
        mean = whole.agg(F.avg(F.col(north) - F.col(south)), F.avg(F.col(east) - F.col(west))).first()
        cell = (mean[0] or 1.0, mean[1] or 1.0)
    height, width = cell if isinstance(cell, tuple) else (cell, cell)
    n_of = lambda lo, hi, size, level: F.floor(hi / size / F.pow(F.lit(2.0), level)) - F.floor(lo / size / F.pow(F.lit(2.0), level)) + 1
    # The level of a box: the finest grid in which it touches few enough cells.
    need = n_of(F.col(south), F.col(north), height, F.lit(0)).cast("double") * n_of(F.col(west), F.col(east), width, F.lit(0)).cast("double")
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(need, F.lit(1.0)) / max_cells) / 2)).cast("int")
    span = lambda lo, hi, size: F.explode(F.sequence(F.floor(lo / size / F.pow(F.lit(2.0), F.col("_level"))),
                                                     F.floor(hi / size / F.pow(F.lit(2.0), F.col("_level")))))
    placed = whole.withColumn("_level", level).withColumn("_row", span(F.col(south), F.col(north), height)).withColumn("_col", span(F.col(west), F.col(east), width))
    placed, n = materialize_counted(placed, "box-cells")
    levels = [r[0] for r in placed.select("_level").distinct().orderBy("_level").collect()]  # as many as doublings of size
    cells = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).withColumn("_plevel", F.explode(F.lit(levels or [0]).cast("array<int>")))
    grid = lambda v, size: F.floor(F.col(v) / size / F.pow(F.lit(2.0), F.col("_plevel")))
    cells = cells.withColumn("_prow", grid(lat, height)).withColumn("_pcol", grid(lon, width))
    same = (F.col("_plevel") == F.col("_level")) & (F.col("_prow") == F.col("_row")) & (F.col("_pcol") == F.col("_col"))
    if n <= BROADCAST_ROWS:
        met = cells.join(F.broadcast(placed), same)
    else:
        salt = F.pmod(F.xxhash64(*points.columns), F.lit(SALTS)).cast("int")
        placed = placed.withColumn("_salt", F.explode(F.lit(list(range(SALTS))).cast("array<int>")))
        # Spark would judge the copies by the size of the file they come from, and broadcast them
        met = cells.withColumn("_psalt", salt).join(placed.hint("merge"), same & (F.col("_psalt") == F.col("_salt")))
    inside = F.col(lat).between(F.col(south), F.col(north)) & F.col(lon).between(F.col(west), F.col(east))
    return met.where(inside).select(*points.columns, *boxes.columns)


def range_join_count(points: DataFrame, boxes: DataFrame | Sequence[tuple], lat: str, lon: str, cls: str, box_name: str = "name") -> DataFrame:
    """Points inside each (possibly overlapping) box, by class.

    ``boxes`` is a table as in :func:`range_join`, or a short list [(name, south, west, north, east)] written in the call:
    that travels as a literal array, each point keeps the boxes that hold it, and there is no join."""
    if isinstance(boxes, DataFrame):
        hits = range_join(points.select(cls, lat, lon), boxes, lat, lon)
    else:
        listed = F.array(*[F.struct(F.lit(n).alias("name"), *[F.lit(float(v)).alias(k) for k, v in zip(("south", "west", "north", "east"), sides, strict=True)])
                           for n, *sides in boxes])
        inside = F.filter(listed, lambda b: F.col(lat).between(b["south"], b["north"]) & F.col(lon).between(b["west"], b["east"]))
        hits = points.select(cls, F.explode(inside).alias("_b")).select(cls, F.col("_b.name").alias(box_name))
    return hits.groupBy(box_name, cls).agg(F.count("*").cast("bigint").alias("n"))


def group_stat_to_rows(df: DataFrame, keys, stat: DataFrame, name: str) -> DataFrame:
    """Join a per-group statistic back onto the rows."""
    return df.join(stat.withColumnRenamed(stat.columns[-1], name), _ks(keys), "left")
