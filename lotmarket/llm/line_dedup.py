"""Line dedup over levelled sorted runs of line hashes.

The store is a log-structured merge tree of Parquet tables.  A *run* holds one row per line key: ``h1, h2`` (a 128-bit
hash), ``n_docs`` (documents that hold the line) and ``owner`` (the largest document id among them).  It is bucketed
and sorted by the hash, so runs merge with each other and with a batch without dealing their rows out again.

Documents come in batches, from the largest ids down.  A new batch's keys are merge-anti-joined against the *settled*
keys of the runs (those that have reached ``min_docs`` documents: their owner can't change any more, as later ids are
smaller); the rest becomes a run of its own at level 0.  When a level holds ``fanout`` runs, they are compacted into
one run of the next level, in which counts add up.  After the last batch everything is compacted once more, and the
keys with ``min_docs`` documents lose their lines except in the owner.

A key that a third of all documents hold is one row per batch after map-side aggregation; the last join (lines with
dropped keys) is a plain equi-join whose line side adaptive execution can split.

Nulls and edge cases: a null or empty text is one empty line and is kept; a document without an id takes part in
nothing and keeps all its lines; repeated rows with one id count as one document; empty tables give empty results;
other columns of the input are kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmarket.llm.common import SPACE_CHARS, ascii_lower, fresh_path, written

KEY = ["h1", "h2"]


def line_keys(docs: DataFrame, min_chars: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row (id, row_hash, place, h1, h2) for each line whose key has at least ``min_chars`` code points.

    The key is the line without ASCII white space at both ends, A-Z lower-cased.
    """
    lines = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("row_hash"),
                        F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("place", "line"))
    key = ascii_lower(F.btrim("line", F.lit(SPACE_CHARS)))
    return (lines.where(F.col("id").isNotNull() & (F.length("line") >= min_chars))
            .withColumn("key", key).where(F.length("key") >= min_chars)
            .select("id", "row_hash", "place", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit("second"), F.col("key")).alias("h2")))


class RunStore:
    """Runs by level, each a bucketed and sorted table in the shared folder; the catalog names it only while it is written."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = [[]]

    def _run(self, rows: DataFrame, name: str) -> DataFrame:
        table = f"line_run_{name}_{uuid.uuid4().hex}"
        (rows.write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", fresh_path(self.spark, table)).saveAsTable(table))
        run = self.spark.table(table)
        self.spark.sql(f"DROP TABLE {table}")  # the frame is bound to its files; nothing is left in a shared catalog
        return run

    @staticmethod
    def _merge(a: DataFrame, b: DataFrame) -> DataFrame:
        """Both runs' keys; documents of two batches differ, so counts add up."""
        b = b.select(*KEY, F.col("n_docs").alias("n_more"), F.col("owner").alias("owner_more"))
        return a.join(b, KEY, "full").select(
            *KEY, (F.coalesce("n_docs", F.lit(0)) + F.coalesce("n_more", F.lit(0))).cast("long").alias("n_docs"),
            F.greatest("owner", "owner_more").alias("owner"))

    def add(self, keys: DataFrame) -> None:
        """Add one batch of (id, h1, h2) rows; a key counts once for each id."""
        fresh = keys.dropDuplicates().groupBy(*KEY).agg(
            F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("owner"))
        for run in (r for level in self.levels for r in level):
            fresh = fresh.join(run.where(F.col("n_docs") >= self.min_docs).select(*KEY), KEY, "left_anti")
        self.levels[0].append(self._run(fresh, "0"))
        for k, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                self._compact(k)

    def _compact(self, k: int) -> None:
        merged = self.levels[k][0]
        for run in self.levels[k][1:]:
            merged = self._merge(merged, run)
        self.levels[k] = []
        if k + 1 == len(self.levels):
            self.levels.append([])
        self.levels[k + 1].append(self._run(merged, str(k + 1)))

    def settled(self) -> DataFrame:
        """(h1, h2, owner) of all keys with at least ``min_docs`` documents, after a last compaction of all runs."""
        runs = [r for level in self.levels for r in level]
        merged = runs[0]
        for run in runs[1:]:
            merged = self._merge(merged, run)
        return written(merged.where(F.col("n_docs") >= self.min_docs).select(*KEY, "owner"), "line-settled")


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, n_batches: int = 4, fanout: int = 2,
                text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` (before) and ``n_dropped``."""
    spark = docs.sparkSession
    keys = line_keys(docs, min_chars, text, doc_id)
    cuts = docs.agg(F.percentile_approx(doc_id, [i / n_batches for i in range(1, n_batches)], 1000)).first()[0] or []
    batch = sum((F.when(F.col("id") < F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    lines = written(keys.withColumn("batch", batch), "line-keys")
    store = RunStore(spark, min_docs, fanout)
    for b in range(n_batches):
        store.add(lines.where(F.col("batch") == b).select("id", *KEY))
    dropped = (lines.join(store.settled(), KEY).where(F.col("id") != F.col("owner"))
               .groupBy("id", "row_hash").agg(F.collect_set("place").alias("__places"))
               .withColumnsRenamed({"id": "__id", "row_hash": "__row_hash"}))
    out = docs.join(dropped, (F.col(doc_id) == F.col("__id")) & (F.xxhash64(F.col(text)) == F.col("__row_hash")), "left")
    parts = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    kept = F.when(F.col("__places").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(
        F.array_join(F.filter(parts, lambda _, i: ~F.array_contains("__places", i)), "\n"))
    return (out.withColumn("kept_text", kept).withColumn("n_lines", F.size(parts).cast("long"))
            .withColumn("n_dropped", F.when(F.col("__places").isNull(), 0).otherwise(F.size("__places")).cast("long"))
            .drop("__id", "__row_hash", "__places"))
