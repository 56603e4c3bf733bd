"""Streaming queries on ``events``: the table is laid out in four
slices of time, each query drains them as micro-batches and reads its sink table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotmarket.plans.catalog import register
from lotmarket.plans.common import finish
from lotmarket.streaming import jobs

SLICES = 4
SLICE_SQL = f"""(epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) * {SLICES}
  // ((SELECT max(epoch_us(ts)) FROM events) - (SELECT min(epoch_us(ts)) FROM events) + 1)"""


def _stream(spark, d, replay_every: int = 0, replay_lag: int = 1):
    folder, files = jobs.stage_by_time(spark.read.schema(jobs.EVENTS_SCHEMA).parquet(f"{d}/events.parquet"), SLICES,
                                       replay_every=replay_every, replay_lag=replay_lag)
    return jobs.events_stream(spark, folder, files)


@register("stream_tumbling", """
SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total
FROM events GROUP BY 1, 2""")
def stream_tumbling(spark, d):
    out = jobs.run_to_table(jobs.tumbling_counts(_stream(spark, d)), "stream-tumbling", mode="update")
    t = jobs.latest(spark.read.parquet(f"{out}/out"), ["w", "event_type"])
    return finish(t.select(F.col("w.start").cast("date").alias("day"), "event_type", "n", "total"))


@register("stream_kpi", """
SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean, round(median(value), 4) AS median
FROM events GROUP BY 1""")
def stream_kpi(spark, d):
    out = jobs.run_to_table(_stream(spark, d), "stream-kpi", per_batch=jobs.value_counts)
    return finish(jobs.kpi_of_counts(spark.read.parquet(f"{out}/out")).select("event_type", "n", "mean", "median"))


@register("stream_dedup", "SELECT DISTINCT event_id, user_id, event_type, ts FROM events")
def stream_dedup(spark, d):
    """Every third event is delivered again a slice later; each event is kept once.  A slice is 7.5 days, so a
    watermark of 16 days still knows the event when its repeat comes."""
    dd = jobs.dedup_within_watermark(_stream(spark, d, replay_every=3), ["event_id"], "16 days")
    out = jobs.run_to_table(dd.select("event_id", "user_id", "event_type", "ts"), "stream-dedup")
    return finish(spark.read.parquet(f"{out}/out").drop("batch_id"))


@register("stream_quality", f"""
SELECT CAST({SLICE_SQL} AS BIGINT) AS batch, count(*) AS rows,
       CAST(sum(CASE WHEN NOT (value BETWEEN 0.0 AND 50.0) THEN 1 ELSE 0 END) AS BIGINT) AS value_violations
FROM events GROUP BY 1""")
def stream_quality(spark, d):
    """A threshold report per micro-batch; the batches go to a table partitioned by day."""
    ev = _stream(spark, d).withColumn("day", F.to_date("ts"))
    out = jobs.run_to_table(ev, "stream-quality", per_batch=jobs.quality_writer({"value": (0.0, 50.0)}, "day"))
    return finish(spark.read.parquet(f"{out}/report").drop("batch_id"))


@register("stream_insert_new", "SELECT DISTINCT event_id, user_id, event_type, ts FROM events")
def stream_insert_new(spark, d):
    """U6 on the stream: every second event comes again three slices (22 days) later, and is ignored."""
    rows = _stream(spark, d, replay_every=2, replay_lag=3).select("event_id", "user_id", "event_type", "ts")
    out = jobs.insert_new(rows, "stream-insert-new", ["event_id"], ["ts", "user_id", "event_type"])
    return finish(spark.read.parquet(f"{out}/out").drop("batch_id"))
