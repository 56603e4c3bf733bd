"""Readers and writers.

Every writer targets a fresh folder (Spark cannot overwrite the path it is
reading) and every reader takes an explicit schema; nothing is inferred.
Scratch folders live under the session's shared checkpoint area.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotmarket.functions import core as fx
from lotmarket.session import scratch_path


def write(df: DataFrame, path: str, fmt: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
          **options) -> str:
    """Format dispatch (csv with header, json lines, parquet)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    for k, v in options.items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def read(spark: SparkSession, path: str | Sequence[str], fmt: str, schema: T.StructType | None = None,
         **options) -> DataFrame:
    """Read with an explicit schema (CSV header on; JSON lines by default,
    ``multiLine=True`` for a JSON array of records)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path) if isinstance(path, str) else r.load(list(path))


def roundtrip(spark: SparkSession, df: DataFrame, fmt: str, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder in ``fmt`` and read it back with its schema."""
    path = scratch_path(spark, name)
    write(df, path, fmt)
    return read(spark, path, fmt, df.schema)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared area: computed once for all that reads them."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """As :func:`materialize`, and the number of rows, observed while they are written."""
    seen = Observation()
    out = materialize(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return out, counts_of(seen).get("n", 0)


def counts_of(seen: Observation) -> dict[str, int]:
    """What an observation counted; nothing where Spark found the rows to be none and left the node out of the plan."""
    try:
        return seen.get
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception):
            raise
        return {}


def publish(df: DataFrame, root: str) -> str:
    """Full refresh.  The rows go to a new version's folder and only then a pointer to it is appended, so readers
    see the old version or the whole new one; returns the version's path."""
    spark = df.sparkSession
    version = f"{root}/versions/{uuid.uuid4().hex}"
    df.write.parquet(version)
    last = spark.read.schema("seq bigint, path string").parquet(f"{root}/pointers").agg(F.max("seq")).first()[0] if _exists(spark, f"{root}/pointers") else None
    spark.createDataFrame([((last or 0) + 1, version)], "seq bigint, path string").coalesce(1).write.mode("append").parquet(f"{root}/pointers")
    return version


def current(spark: SparkSession, root: str) -> DataFrame:
    """The version that the last pointer names."""
    pointers = spark.read.schema("seq bigint, path string").parquet(f"{root}/pointers")
    return spark.read.parquet(pointers.agg(F.max_by("path", "seq")).first()[0])


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, asked of the file system that Spark would use."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


LOAD = "load_id"


def append_load(df: DataFrame, path: str, load_id: str, partition_by: Sequence[str]) -> None:
    """Append one load to a partitioned table, exactly once however often it is tried: its rows lie under its own
    ``load_id``, and a repeated write replaces the partitions that it writes and no others.  A load must bring the same
    partitions each time."""
    rows = df.withColumn(LOAD, F.lit(load_id))
    write(rows, path, "parquet", mode="overwrite", partition_by=[LOAD, *partition_by], partitionOverwriteMode="dynamic")


def append_batches(spark: SparkSession, batches: Sequence[DataFrame], partition_by: Sequence[str],
                   name: str) -> DataFrame:
    """Append several loads to one partitioned parquet table; read it back."""
    path = scratch_path(spark, name)
    for i, b in enumerate(batches):
        append_load(b, path, f"load-{i}", partition_by)
    return spark.read.parquet(path).drop(LOAD)


def json_map_rows(df: DataFrame, text: str, value_schema: T.DataType, key_name: str = "key") -> DataFrame:
    """Parse a JSON object keyed by id into rows (``from_json`` with a map
    type, then ``explode``)."""
    parsed = df.withColumn("_m", F.from_json(F.col(text), T.MapType(T.StringType(), value_schema)))
    keep = [c for c in df.columns if c != text]
    return parsed.select(*keep, F.explode("_m").alias(key_name, "_v"))


def defaults(df: DataFrame, struct_col: str, fields: Mapping[str, object]) -> DataFrame:
    """Expand a struct with a per-field default for missing values (S3's 0)."""
    return df.select(*[c for c in df.columns if c != struct_col],
                     *[F.coalesce(F.col(f"{struct_col}.{f}"), F.lit(d)).alias(f) for f, d in fields.items()])


def explode_nested(df: DataFrame, array_col: str, alias: str = "item") -> DataFrame:
    """One row per array element; a NULL or empty array keeps its row."""
    return df.select("*", F.explode_outer(F.col(array_col)).alias(alias)).drop(array_col)


def ingest_files(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet",
                 crawl_date: str = "1970-01-01", upper_headers: bool = True,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """S7 + U1: one multi-path read of per-source folders (schemas merged, missing
    columns NULL), source label from the file's folder name through a literal
    map (no join), upper-case headers and provenance columns (source, crawl
    date, row fingerprint)."""
    rdr = spark.read.option("mergeSchema", "true") if fmt == "parquet" else spark.read
    df = rdr.format(fmt).load(list(paths.values()))
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1)
    names = F.create_map(*[x for src, p in paths.items() for x in (F.lit(p.rstrip("/").rsplit("/", 1)[-1]),
                                                                   F.lit(src))])
    j = df.withColumn("source", names[folder])
    data_cols = list(columns) if columns else list(df.columns)
    out = j.select(*[F.col(c).alias(c.strip().upper() if upper_headers else c) for c in data_cols],
                   F.col("source").alias("SOURCE"), F.lit(crawl_date).cast("date").alias("CRAWL_DATE"),
                   fx.fingerprint16(*data_cols).alias("ROW_HASH"))
    return out


#: Bytes of one range of a file's print, and of one read within a range.
RANGE_BYTES, READ_BYTES = 1 << 26, 1 << 20


def _open(path: str):
    """A file of any file system that Arrow knows, for reading from any place in it."""
    from pyarrow import fs

    if path.startswith(("file:", "/")):  # Spark writes file:/a b%20 with nothing encoded, which is no URI for Arrow
        return fs.LocalFileSystem().open_input_file(re.sub("^file:/*", "/", path))
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _pieces(path: str, start: int, length: int) -> Iterator[bytes]:
    """The bytes of a range of a file, READ_BYTES at a time."""
    with _open(path) as f:
        f.seek(start)
        while length:
            piece = f.read(min(READ_BYTES, length))
            if not piece:
                raise OSError(f"{path} is shorter than when it was listed")
            yield piece
            length -= len(piece)


def _listed(spark: SparkSession, path_glob: str) -> DataFrame:
    """(path, bytes) of the files, whose content isn't read here.  Spark's file listing leaves out empty files."""
    return spark.read.format("binaryFile").load(path_glob).select("path", F.col("length").alias("bytes"))


def _file_digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The MD5 of each row's file."""
    for rows in frames:
        digests = []
        for path, length in zip(rows["path"], rows["bytes"], strict=True):
            digest = hashlib.md5(usedforsecurity=False)
            for piece in _pieces(path, 0, int(length)):
                digest.update(piece)
            digests.append(digest.hexdigest())
        yield rows.assign(digest=digests)


def file_fingerprints(spark: SparkSession, path_glob: str) -> DataFrame:
    """First 16 hex digits of the MD5 of each file.

    MD5 goes through a file in order, so a file is one task's work, but it is read in pieces: no row holds file content
    and a file may have any size.  ``file_range_prints`` spreads one file over many tasks.
    """
    dealt = _listed(spark, path_glob).repartition("path")
    read = dealt.mapInPandas(_file_digests, "path string, bytes bigint, digest string")
    return read.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "bytes", F.substring("digest", 1, 16).alias("file_hash"))


def _range_digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sha256 of each row's range, read in pieces of READ_BYTES."""
    for rows in frames:
        digests = []
        for path, start, length in zip(rows["path"], rows["start"], rows["length"], strict=True):
            digest = hashlib.sha256()
            for piece in _pieces(path, int(start), int(length)):
                digest.update(piece)
            digests.append(digest.hexdigest())
        yield rows.assign(digest=digests)


def file_range_prints(spark: SparkSession, path_glob: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """S8 for files of any size: a print of its own form, made of the digests of a file's ranges.

    Files are cut into ranges of ``range_bytes``; each range is a row that a task reads and hashes by itself, so a file
    of terabytes is spread over all tasks and no row holds file content.  The print is the sha256 of the ranges' sha256 digests (lowercase hex), joined in order; it depends on ``range_bytes``
    and differs from the file's own digest.  Files with one name in different folders keep rows of their own.
    """
    files = _listed(spark, path_glob)
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(range_bytes).cast("bigint"))
    ranges = files.select("path", "bytes", F.explode(starts).alias("start"))
    ranges = ranges.withColumn("length", F.least(F.lit(range_bytes).cast("bigint"), F.col("bytes") - F.col("start")))
    dealt = ranges.repartition("path", "start")
    read = dealt.mapInPandas(_range_digests, "path string, bytes bigint, start bigint, length bigint, digest string")
    parts = F.sort_array(F.collect_list(F.struct("start", "digest")))
    out = read.groupBy("path", "bytes").agg(F.count("*").alias("n_ranges"), parts.alias("parts"))
    return out.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "bytes", "n_ranges",
                      F.sha2(F.array_join(F.transform("parts", lambda p: p["digest"]), ""), 256).alias("file_print"))


def bucketed(df: DataFrame, keys: Sequence[str], name: str, buckets: int | None = None, table: str | None = None) -> DataFrame:
    """Write rows once, bucketed and sorted by ``keys``, one file a bucket; joins and groupings by exactly these keys
    with tables of as many buckets then need no exchange.

    With ``table`` the catalog keeps the layout under that name (replacing an older one).  Without, the catalog entry
    goes as soon as the frame is bound to its files, so nothing piles up in a shared metastore; the files stay in the
    run's shared folder.  ``buckets`` defaults to the session's shuffle partitions; give some 200 MB a bucket.  All
    rows of one key are in one bucket: lay out by keys that no third of the rows shares (ids, not regions).
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    entry = table or f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    (df.repartition(n, *keys).write.format("parquet").mode("overwrite").bucketBy(n, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(entry))
    rows = spark.table(entry)
    if table is None:
        spark.sql(f"DROP TABLE {entry}")
    return rows
