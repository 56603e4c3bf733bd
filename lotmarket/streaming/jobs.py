"""Structured Streaming jobs over the ``events`` table.

The source is a file stream; ``stage_by_time`` lays a table out as slices of
time, so a job sees several micro-batches in time order and its watermark moves.
Jobs run with ``trigger(availableNow=True)``: a test or a scheduled run drains
what is there and stops.

Sinks are Parquet tables with a folder per batch id, overwritten as a whole, so a
batch that is tried again replaces its first try.  ``run_to_table`` keeps table
and checkpoint under one job folder: a job started again on the same folder goes
on where it stopped; without a folder it gets a fresh one in the shared
checkpoint area.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotmarket.session import scratch_path

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def events_stream(spark: SparkSession, folder: str, max_files: int = 1, glob: str = "*.parquet") -> DataFrame:
    """File stream of a folder of events with event time as a real timestamp
    (watermarks need TIMESTAMP, not TIMESTAMP_NTZ; the session zone is UTC)."""
    s = (spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", glob)
         .option("maxFilesPerTrigger", max_files).parquet(folder))
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def time_slice(events: DataFrame, slices: int) -> DataFrame:
    """``events`` with ``slice``: which of ``slices`` equal parts of the table's time a row is in."""
    from lotmarket.operators.common import attach
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    span = events.agg(F.min(us).alias("_lo"), F.max(us).alias("_hi"))
    part = F.expr(f"(unix_micros(cast(ts AS timestamp)) - _lo) * {slices} div (_hi - _lo + 1)")
    return attach(events, span).withColumn("slice", part).drop("_lo", "_hi")


def stage_by_time(events: DataFrame, slices: int = 4, files: int = 2, replay_every: int = 0, replay_lag: int = 1) -> tuple[str, int]:
    """Write the events slice by slice, oldest first, ``files`` files each: (folder, files per slice).

    The table is read once and laid out by slice; the slices are then fed from there.  With ``replay_every`` k, each
    slice also brings every k-th event of the slice ``replay_lag`` before it once more, as a source that delivers at
    least once does."""
    spark = events.sparkSession
    base = scratch_path(spark, "events-by-time")
    folder, cut = f"{base}/events", f"{base}/slices"
    time_slice(events, slices).select(*EVENTS_SCHEMA.names, "slice").write.partitionBy("slice").parquet(cut)
    laid = spark.read.schema(T.StructType([*EVENTS_SCHEMA.fields, T.StructField("slice", T.LongType())])).parquet(cut)
    for i in range(slices):
        rows = laid.where(F.col("slice") == i)
        if replay_every:
            rows = rows.union(laid.where((F.col("slice") == i - replay_lag) & (F.col("event_id") % replay_every == 0)))
        rows.select(*EVENTS_SCHEMA.names).repartition(files).write.mode("append").parquet(folder)
    return folder, files


def run_to_table(df: DataFrame, name: str, mode: str = "append", folder: str | None = None,
                 per_batch: Callable[[DataFrame, int], Mapping[str, DataFrame]] | None = None) -> str:
    """Drain the stream (availableNow) into Parquet tables under the job's folder; returns the folder of the table.

    A batch goes to ``out/batch_id=N``; ``per_batch`` may name several tables (and what of the batch goes there),
    each with a folder per batch.  Readers find ``batch_id`` as a column.
    """
    base = folder or scratch_path(df.sparkSession, name)

    def sink(batch: DataFrame, epoch: int) -> None:
        for table, rows in (per_batch(batch, epoch) if per_batch else {"out": batch}).items():
            rows.write.mode("overwrite").parquet(f"{base}/{table}/batch_id={epoch}")

    q = (df.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/checkpoint")
         .foreachBatch(sink).trigger(availableNow=True).start())
    q.awaitTermination()
    return base


def tumbling_counts(events: DataFrame, width: str = "1 day", delay: str = "1 day") -> DataFrame:
    """ST1: tumbling-window count and sum per event type; windows behind the watermark leave the state."""
    return (events.withWatermark("ts", delay)
            .groupBy(F.window("ts", width).alias("w"), "event_type")
            .agg(F.count("*").cast("bigint").alias("n"), F.sum("value").alias("total")))


def latest(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last version of each key from a table written in update mode."""
    rest = [c for c in table.columns if c not in (*keys, "batch_id")]
    newest = F.max_by(F.struct(*rest), "batch_id")
    return table.groupBy(*keys).agg(newest.alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def dedup_within_watermark(events: DataFrame, keys: Sequence[str], delay: str = "1 hour") -> DataFrame:
    """ST2: drop repeats of a key arriving within the watermark delay."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


def insert_new(events: DataFrame, name: str, keys: Sequence[str], order: Sequence[str], folder: str | None = None) -> str:
    """U6 on a stream: rows whose key no earlier batch has brought, whenever that was; of several in one batch the first
    in ``order``.  Returns the folder of the table.

    The table itself says which keys are known: a batch's new keys are looked up in the key columns of all batches with a
    smaller id.  So there is no state that could be dropped or that grows in memory; a batch that is tried again sees
    what its first try saw and replaces it, and a job started again on its folder goes on to the same table.  Up to
    ``BROADCAST_ROWS`` keys of a batch travel to the table's rows, which aren't shuffled; beyond, both sides are.
    """
    from lotmarket.operators.common import BROADCAST_ROWS
    from lotmarket.operators.relational import dedup_first
    from lotmarket.sources.files import materialize_counted
    base = folder or scratch_path(events.sparkSession, name)
    ks = list(keys)

    def fresh(batch: DataFrame, epoch: int) -> Mapping[str, DataFrame]:
        first, n = materialize_counted(dedup_first(batch, ks, order), "batch-first")
        if epoch == 0 or not n:
            return {"out": first}
        mine = first.select(*ks)
        known = batch.sparkSession.read.schema(T.StructType([*first.schema.fields, T.StructField("batch_id", T.LongType())])).parquet(f"{base}/out")
        seen = known.where(F.col("batch_id") < epoch).join(F.broadcast(mine) if n <= BROADCAST_ROWS else mine, ks, "left_semi").select(*ks)
        return {"out": first.join(seen, ks, "left_anti").select(*first.columns)}

    return run_to_table(events, name, folder=base, per_batch=fresh)


def value_counts(batch: DataFrame, _epoch: int) -> Mapping[str, DataFrame]:
    """ST4: a batch's rows counted per type and value.  The running figures are read from the table of counts
    (``kpi_of_counts``), so the stream keeps no state at all and the median stays exact."""
    return {"out": batch.groupBy("event_type", "value").agg(F.count("*").cast("bigint").alias("c"))}


def kpi_of_counts(counts: DataFrame) -> DataFrame:
    """Count, mean and exact median per type from the counts of all batches."""
    from lotmarket.operators.stats import group_quantiles
    basics = counts.groupBy("event_type").agg(
        F.sum("c").cast("bigint").alias("n"), F.try_divide(F.sum(F.col("value") * F.col("c")), F.sum(F.when(F.col("value").isNotNull(), F.col("c")))).alias("mean"))
    median = group_quantiles(counts, "event_type", "value", {"median": 0.5}, count="c")
    return basics.join(median, "event_type", "left")


def quality_writer(thresholds: Mapping[str, tuple], partition_by: str):
    """ST3: per micro-batch a threshold report and the batch itself, partitioned, both under the batch's id."""
    def tables(batch: DataFrame, epoch: int) -> Mapping[str, DataFrame]:
        report = batch.agg(F.lit(epoch).cast("bigint").alias("batch"), F.count("*").cast("bigint").alias("rows"),
                           *[F.count_if(~F.col(c).between(lo, hi)).cast("bigint").alias(f"{c}_violations")
                             for c, (lo, hi) in thresholds.items()])
        return {"report": report, "out": batch.repartition(partition_by)}
    return tables
