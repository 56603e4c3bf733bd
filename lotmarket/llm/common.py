"""Helpers shared by the text operators: tables written to the shared folder, Arrow batches cut to size."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The ASCII white space that separates words, as a Java regex class and as a plain string.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: Bytes of text that one vectorised step handles; a longer document is a step of its own.
STEP_BYTES = 1 << 19
#: Rows of an Arrow batch: whole texts are long, and several batches are in memory for each task.
BATCH_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir.

    Only a local session may do without it and gets a scratch folder; anywhere else an unset folder is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lotmarket-ckpt-", dir="/tmp"))
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession) -> None:
    """Let the session send at most BATCH_ROWS rows at a time to Python tasks; fewer stay as they are."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def gathered(batches: Iterator[pa.RecordBatch], rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """Batches of narrow rows put together to at least ``rows`` each, but for the last."""
    held: list[pa.RecordBatch] = []
    have = 0
    for batch in batches:
        held.append(batch)
        have += batch.num_rows
        if have >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, have = [], 0
    if have:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends here, and a lost executor loses none of it."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it, in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text: maximal runs of characters other than ASCII white space; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+"), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_steps(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Record batches cut into steps of at most about STEP_BYTES of text, at least one row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = text_offsets(batch.column(batch.schema.get_field_index(column)))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + STEP_BYTES, side="right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def _offsets(array: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    kind = np.int64 if wide else np.int32
    return np.frombuffer(array.buffers()[1], dtype=kind)[array.offset:array.offset + len(array) + 1].astype(np.int64)


def text_offsets(array: pa.Array) -> np.ndarray:
    """Byte offsets of a string column's values (a null has no bytes), one more than rows."""
    return _offsets(array)


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column on end, and the offset at which each row begins (one more than rows).

    A null is an empty text.
    """
    if array.null_count:
        array = array.fill_null("")
    offsets = _offsets(array)
    data = array.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on uint64 values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n-1) modulo 2 ** 64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


def list_array(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    """Rows of lists from their values on end and the length of each."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(values))


def histogram(docs: DataFrame, slots: Callable[[pa.RecordBatch], np.ndarray], size: int, text: str = "text") -> np.ndarray:
    """How often ``slots`` gives each slot number below ``size`` over all rows' steps.

    Each task sends its counts in compressed blocks, which are added up block by block, so what reaches the driver is
    one table of ``size`` counts, whatever the number of rows.  Counts stop at 2 ** 32 - 1.
    """
    bounded_batches(docs.sparkSession)
    block = min(size, 1 << 14)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.uint32)
        for step in text_steps(batches, text):
            total += np.bincount(slots(step), minlength=size).astype(np.uint32)
        blocks = [(i, x.tobytes()) for i, x in enumerate(total.reshape(-1, block)) if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in blocks], pa.int32()),
                                          pa.array([zlib.compress(x, 1) for _, x in blocks], pa.binary())], names=["block", "counts"])

    def add(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(block, dtype=np.uint64)
        for part in parts:
            for x in part["counts"]:
                total += np.frombuffer(zlib.decompress(x), dtype=np.uint32)
        yield pd.DataFrame({"block": [key[0]], "counts": [np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()]})

    schema = "block int, counts binary"
    out = np.zeros(size, dtype=np.uint32)
    for b in docs.mapInArrow(count, schema).groupBy("block").applyInPandas(add, schema).collect():
        out[b["block"] * block:(b["block"] + 1) * block] = np.frombuffer(b["counts"], dtype=np.uint32)
    return out


PACKED = "__packed"


def pack_texts(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``__packed``, the text compressed, for a shuffle that moves whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for step in text_steps(batches, text):
            raw, offsets = text_bytes(step.column(step.schema.get_field_index(text)))
            packed = [press.compress(raw[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            rest = [step.column(step.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(packed, pa.binary())], names=[*keep, PACKED])

    bounded_batches(docs.sparkSession)
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(PACKED, T.BinaryType())])
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def unpack_texts(column: pa.Array) -> list[bytes]:
    press = zstandard.ZstdDecompressor()
    return [press.decompress(x) for x in column.to_pylist()]
