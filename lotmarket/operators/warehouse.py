"""Warehouse build: dimensions, surrogate keys, fact build.

Surrogate ids: ``dense_ids``, which the dimensions use, gives 1..N in key order
without a single-partition window: rows are range-partitioned on the key,
checkpointed (so both passes see the same partition bounds, also after an
executor loss), counted per partition, and numbered within each partition plus
the partition's offset.  ``hash_ids`` (60 bits of md5 of the natural key) is
the way without a shuffle, for dimensions with a row per fact row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotmarket.functions import core as fx
from lotmarket.operators.common import join_small
from lotmarket.session import ensure_checkpoint_dir


def hash_ids(df: DataFrame, keys: Sequence[str], name: str, seed: int = 42) -> DataFrame:
    """Stable id from the natural key without a shuffle: the first 60 bits of md5(seed|key|key...), portable to SQL.

    NULL keys count as the word NULL."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys]
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return df.withColumn(name, F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint"))


def dense_ids(df: DataFrame, order: Sequence[Column | str], name: str, partitions: int | None = None) -> DataFrame:
    """Dense ids 1..N following ``order``, which may hold descending columns (ties broken by the order columns only;
    give a total order).  Scales with the data: no global sort into one task.  So it also ranks a whole table."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id())
    ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy("_pid").agg(F.count("*").alias("_c"))
    offs = counts.withColumn(
        "_off", F.coalesce(F.sum("_c").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0))).select("_pid", "_off")
    w = Window.partitionBy("_pid").orderBy(*order)
    numbered = ranged.withColumn("_rn", F.row_number().over(w))
    # offsets: one row per partition (bounded by the partition count) -> broadcast
    out = numbered.join(F.broadcast(offs), "_pid")
    return out.withColumn(name, (F.col("_off") + F.col("_rn")).cast("bigint")).drop("_pid", "_off", "_rn")


def distinct_dimension(df: DataFrame, keys: Sequence[str], name: str, dense: bool = True,
                       extra: Mapping[str, str] | None = None) -> DataFrame:
    """K2/K3/K4: distinct natural keys with a surrogate id; ``extra`` adds absent
    columns as typed NULLs (K4)."""
    dim = df.select(*keys).distinct()
    for c, t in (extra or {}).items():
        dim = dim.withColumn(c, F.lit(None).cast(t))
    return dense_ids(dim, keys, name) if dense else hash_ids(dim, keys, name)


def coerce_measures(df: DataFrame, numbers: Sequence[str] = (), ints: Sequence[str] = (), texts: Sequence[str] = (),
                    names: Sequence[str] = (), default: int = 0, width: int = 20) -> DataFrame:
    """The forms in which a fact's columns are stored, whatever text or number they come as.

    ``numbers`` become doubles (NULL where there is none), ``ints`` whole numbers (``default`` where there is none),
    ``texts`` lose outer spaces and what exceeds ``width`` characters, ``names`` (lookup keys) lose outer spaces."""
    made = {c: fx.coerce_numeric(c) for c in numbers} | {c: fx.safe_int(c, default).cast("bigint") for c in ints} \
        | {c: fx.trim_truncate(c, width) for c in texts} | {c: F.trim(F.col(c)) for c in names}
    return df.withColumns(made)


def attach_key(fact: DataFrame, dim: DataFrame, keys: Sequence[str], name: str, default) -> DataFrame:
    """Resolve a surrogate key on the natural key, with a default for misses.

    A bounded dimension is broadcast after a check of its row count, a larger one meets the fact by salted keys."""
    d = dim.select(*keys, F.col(name).alias(f"_dv_{name}"))
    j = join_small(fact, d, keys, null_safe=True)
    return j.withColumn(name, F.coalesce(F.col(f"_dv_{name}"), F.lit(default))).drop(f"_dv_{name}")
