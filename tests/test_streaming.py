"""Streams equal their batch counterparts; watermark semantics."""

import datetime as dt

from pyspark.sql import functions as F

from lotmarket.plans import catalog
from lotmarket.session import scratch_path
from lotmarket.streaming import jobs
from conftest import SF_SMALL


def test_stream_tumbling_equals_batch(spark):
    got = {(r.day, r.event_type): (r.n, r.total) for r in catalog.queries()["stream_tumbling"](spark, SF_SMALL).collect()}
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    exp = {(r.day, r.event_type): (r.n, round(r.total, 4)) for r in
           ev.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"),
                                                                       F.sum("value").alias("total")).collect()}
    assert got == exp


def test_late_rows_and_duplicates(spark):
    folder = scratch_path(spark, "late") + "/events"
    # batch 1: key (2, a) on Jan 1, key (1, a) on Jan 3 -> watermark Jan 2 23:00
    b1 = [(1, dt.datetime(2024, 1, 1, 0, 0), 2, "a", 1.0, "{}"),
          (2, dt.datetime(2024, 1, 3, 0, 0), 1, "a", 1.0, "{}")]
    spark.createDataFrame(b1, jobs.EVENTS_SCHEMA).coalesce(1).write.parquet(folder)
    # batch 2: a repeat of (1, a) inside the watermark, a row behind it, a new key
    b2 = [(3, dt.datetime(2024, 1, 3, 0, 10), 1, "a", 1.0, "{}"),
          (4, dt.datetime(2024, 1, 1, 1, 0), 2, "a", 1.0, "{}"),
          (5, dt.datetime(2024, 1, 3, 0, 30), 3, "a", 1.0, "{}")]
    spark.createDataFrame(b2, jobs.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    stream = jobs.events_stream(spark, folder, max_files=1, glob="*.parquet")
    dd = jobs.dedup_within_watermark(stream, ["user_id", "event_type"], "1 hour")
    out = spark.read.parquet(jobs.run_to_table(dd.select("event_id"), "dedup-test") + "/out")
    assert sorted(r.event_id for r in out.collect()) == [1, 2, 5]


def _events(days, first=0):
    return [(first + i, dt.datetime(2024, 1, 1) + dt.timedelta(days=x), 1, "a", float(x), "{}") for i, x in enumerate(days)]


def test_repeats_weeks_apart(spark):
    """Events two and three weeks apart all stay; a repeat within the watermark goes."""
    events = spark.createDataFrame(_events([0, 1, 14, 15, 35, 36, 60]), jobs.EVENTS_SCHEMA)
    folder, files = jobs.stage_by_time(events, 4, replay_every=1)
    assert spark.read.parquet(folder).count() > 7
    dd = jobs.dedup_within_watermark(jobs.events_stream(spark, folder, files), ["event_id"], "40 days")
    out = jobs.run_to_table(dd, "weeks")
    got = spark.read.parquet(f"{out}/out")
    assert sorted(r.event_id for r in got.collect()) == list(range(7))
    assert got.select("batch_id").distinct().count() > 1


def test_restart_goes_on_and_a_repeated_batch_replaces_itself(spark):
    source, job = scratch_path(spark, "restart") + "/events", scratch_path(spark, "restart-job")
    for days, first in (([0, 1], 0), ([2, 3, 4], 2)):
        spark.createDataFrame(_events(days, first), jobs.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(source)
        out = jobs.run_to_table(jobs.events_stream(spark, source), "restart", folder=job, per_batch=jobs.value_counts)
    counts = spark.read.parquet(f"{out}/out")
    assert {r["batch_id"]: r["n"] for r in counts.groupBy("batch_id").agg(F.sum("c").alias("n")).collect()} == {0: 2, 1: 3}
    row = jobs.kpi_of_counts(counts).first()
    assert (row["n"], row["mean"], row["median"]) == (5, 2.0, 2.0)
    again = jobs.value_counts(spark.createDataFrame(_events([2, 3, 4], 2), jobs.EVENTS_SCHEMA), 1)["out"]
    again.write.mode("overwrite").parquet(f"{out}/out/batch_id=1")
    assert jobs.kpi_of_counts(spark.read.parquet(f"{out}/out")).first()["n"] == 5


def test_late_windows_leave_the_state(spark):
    events = spark.createDataFrame(_events([0, 0.5, 10, 20, 21, 0.6]), jobs.EVENTS_SCHEMA)
    folder = scratch_path(spark, "late-windows") + "/events"
    for part in (events.where("event_id < 2"), events.where("event_id IN (2, 3)"), events.where("event_id = 4"),
                 events.where("event_id = 5")):
        part.coalesce(1).write.mode("append").parquet(folder)
    out = jobs.run_to_table(jobs.tumbling_counts(jobs.events_stream(spark, folder)), "late", mode="update")
    got = {r["w"]["start"].day: r["n"] for r in jobs.latest(spark.read.parquet(f"{out}/out"), ["w", "event_type"]).collect()}
    assert got == {1: 2, 11: 1, 21: 1, 22: 1}  # the last event is 20 days late


def _insert_batches(spark, name, batches):
    folder = scratch_path(spark, name) + "/events"
    for rows in batches:
        spark.createDataFrame(rows, jobs.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return folder


def test_insert_new_knows_keys_for_all_time_and_restarts(spark, monkeypatch):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    row = lambda i, n, user: (i, day(n), user, "a", 1.0, "{}")
    first = [row(1, 5, 50), row(2, 0, 1), row(1, 0, 51), row(1, 0, 49)]
    folder = _insert_batches(spark, "ins", [first])
    base = scratch_path(spark, "ins-job")
    run = lambda: jobs.insert_new(jobs.events_stream(spark, folder).select("event_id", "user_id", "ts"), "ins", ["event_id"], ["ts", "user_id"], folder=base)
    run()
    spark.createDataFrame([row(1, 400, 9), row(3, 400, 9), row(2, 900, 9)], jobs.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    spark.createDataFrame([row(3, 800, 8), row(4, 1, 8)], jobs.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    expected = [(1, 49), (2, 1), (3, 9), (4, 8)]
    rows = lambda: sorted((r.event_id, r.user_id) for r in spark.read.parquet(f"{base}/out").collect())

    # the second batch is written, then the job dies before the batch is committed
    whole, calls = jobs.run_to_table, []

    def dying(df, name, mode="append", folder=None, per_batch=None):
        def once(batch, epoch):
            tables = per_batch(batch, epoch)
            if epoch == 1 and not calls:
                calls.append(epoch)
                for table, part in tables.items():
                    part.write.mode("overwrite").parquet(f"{folder}/{table}/batch_id={epoch}")
                raise RuntimeError("killed")
            return tables
        return whole(df, name, mode, folder, once)

    monkeypatch.setattr(jobs, "run_to_table", dying)
    try:
        run()
    except Exception as e:
        assert "killed" in str(e)
    assert calls == [1]
    run()
    assert rows() == expected
    run()
    assert rows() == expected


def test_insert_new_with_keys_beyond_the_broadcast(spark, monkeypatch):
    from lotmarket.operators import common
    monkeypatch.setattr(common, "BROADCAST_ROWS", 1)
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    folder = _insert_batches(spark, "ins2", [[(i, day(i), 1, "a", 1.0, "{}") for i in range(5)], [(i, day(90), 2, "a", 1.0, "{}") for i in range(3, 9)]])
    out = jobs.insert_new(jobs.events_stream(spark, folder).select("event_id", "user_id", "ts"), "ins2", ["event_id"], ["ts"])
    got = sorted((r.event_id, r.user_id) for r in spark.read.parquet(f"{out}/out").collect())
    assert got == [(i, 1) for i in range(5)] + [(i, 2) for i in range(5, 9)]
