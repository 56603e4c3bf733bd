"""Suffix-array dedup: bytes covered by a string of LENGTH bytes that also starts anywhere else are removed.

1.  *Anchors* (``anchors``): each string of LENGTH bytes has one, fixed by its content, so equal strings have equal
    anchors at equal places.  An anchor's *stretch* is the union of the strings it anchors, some 114 neighbouring
    starts.  One row per anchor: its k-gram's hash and its stretch's.
2.  Anchors whose k-gram comes once are done.  A stretch that comes twice as a whole, by counting hashes after map-side
    aggregation, has all its strings repeated.  These are most, and take no text with them.
3.  What is left are single stretches that share their k-gram with others, at the ends of common passages.  Their bytes
    are fetched, with one copy of each other stretch of the k-gram, and dealt by k-gram.  A group of more than ``BOUND``
    stretches is first split, without loss, by halves of the strings' starts: strings of one half have a common core,
    and only stretches with equal cores stay together.  A part with one start left holds equal strings only.
4.  A task lays some groups' stretches side by side, in blocks of BLOCK bytes at fixed distances from the anchor, and
    builds the suffix array over the blocks (``lyndon_suffixes``, linear grouping).  Neighbours in it with the next
    INNER blocks in common form a class.  A string is INNER whole blocks and a part of a block at each end, so two
    strings at one distance from the anchor are equal if their inner blocks are of one class and both end parts agree.
5.  Spans go back to the texts by the row's key; they are united, and the bytes outside are kept.

Nothing is compared pair by pair, no group is held beyond BOUND stretches, and matches never cross documents.  Texts
are shuffled twice, compressed.  Hash equality (64 bits of k-gram and 64 of stretch) stands for equality.

Nulls and edge cases: a null text is an empty one; texts under LENGTH bytes keep everything; repeated rows are copies
of each other; ids may be null or repeated; an empty table gives an empty result; other columns of the input are kept
unless they have a result column's name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotmarket.llm.anchors import LENGTH, REACH, find, prefix_sums, span_hashes
from lotmarket.llm.common import PACKED, bounded_batches, mix64, pack_texts, text_bytes, text_steps, unpack_texts, written
from lotmarket.llm.lyndon_suffixes import suffix_array
from lotmarket.llm.shingles import BYTE_VALUES, place_powers

#: Stretches that one suffix array takes at most.
BOUND = 2000
BLOCK = 25
#: Whole blocks in a string, whatever part of a block comes before them.
INNER = LENGTH // BLOCK - 1
#: Columns of stretches laid side by side: the anchor at REACH, strings from column 0 on, whole blocks.
WIDTH = -(-(REACH + LENGTH) // BLOCK) * BLOCK


def _key(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__key``, which stands for a row's whole content; its columns may be of any type but map."""
    return docs.withColumn("__key", F.xxhash64(*docs.columns))


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(key, place, before, starts, gram, stretch) of all anchors in the texts of docs (key, text).

    The anchor is at byte ``place``; ``before`` bytes before it starts the first of its ``starts`` strings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in text_steps(batches, "text"):
            raw, offsets = text_bytes(step.column(1))
            sums = prefix_sums(raw)
            place, first, last, gram = find(raw, offsets, sums)
            row = np.searchsorted(offsets, first, side="right") - 1
            before = place - first
            stretch = mix64(span_hashes(sums, first, last + LENGTH) + before.astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [step.column(0).take(pa.array(row)), pa.array(place - offsets[row]), pa.array(before.astype(np.int32)),
                 pa.array((last - first + 1).astype(np.int32)), pa.array(gram.view(np.int64)), pa.array(stretch.view(np.int64))],
                names=["key", "place", "before", "starts", "gram", "stretch"])

    return docs.mapInArrow(run, "key bigint, place bigint, before int, starts int, gram bigint, stretch bigint")


#: A single stretch or one copy of a repeated one, with its bytes, in the group of those it may share strings with.
_STRETCH = "grp bigint, low int, high int, single boolean, key bigint, place bigint, before int, starts int, bytes binary"


def fetched(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The stretches' bytes; members has (key, wanted: array of (gram, single, place, before, starts))."""
    together = pack_texts(docs, "text", ["key"]).join(members, "key").select(PACKED, "key", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                raw = press.decompress(batch.column(0)[i].as_py())
                want = batch.column(2)[i].values
                gram, single, place, before, starts = (want.field(c) for c in ("gram", "single", "place", "before", "starts"))
                n = len(gram)
                begin = place.to_numpy() - before.to_numpy()
                texts = [raw[b:b + s + LENGTH - 1] for b, s in zip(begin.tolist(), starts.to_pylist(), strict=True)]
                full = lambda v, t, n=n: pa.array(np.full(n, v), t)
                yield pa.RecordBatch.from_arrays(
                    [gram, full(0, pa.int32()), full(REACH + 1, pa.int32()), single, full(batch.column(1)[i].as_py(), pa.int64()),
                     place, before, starts, pa.array(texts, pa.binary())],
                    names=["grp", "low", "high", "single", "key", "place", "before", "starts", "bytes"])

    return together.mapInArrow(run, _STRETCH)


def _matrix(before: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The stretches as rows of WIDTH bytes, the anchor at column REACH, and where each ends."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = REACH - before
    flat = np.zeros(len(texts) * WIDTH, dtype=np.uint8)
    row = np.repeat(np.arange(len(texts)), lengths)
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    flat[row * WIDTH + begin[row] + inside] = np.frombuffer(b"".join(texts), dtype=np.uint8)
    return flat.reshape(-1, WIDTH), begin + lengths


def _sums(matrix: np.ndarray) -> np.ndarray:
    up, _ = place_powers(WIDTH)
    out = np.zeros((len(matrix), WIDTH + 1), dtype=np.uint64)
    np.cumsum(BYTE_VALUES[matrix] * up, axis=1, out=out[:, 1:])
    return out


def repeated_starts(group: np.ndarray, before: np.ndarray, starts: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of all strings in the stretches: the stretch of each, and whether its group has it twice.

    Strings come stretch by stretch, in order of their starts.
    """
    matrix, end = _matrix(before, texts)
    sums = _sums(matrix)
    edges = np.arange(0, WIDTH + 1, BLOCK)
    whole = (edges[:-1] >= (REACH - before)[:, None]) & (edges[1:] <= end[:, None])
    content = mix64(sums[:, edges[1:]] - sums[:, edges[:-1]] + edges[1:].astype(np.uint64))
    content = mix64(content + mix64(group.view(np.uint64))[:, None])
    _, symbol = np.unique(content[whole], return_inverse=True)
    # Each stretch's whole blocks on end, then a 1; a 0 at the very end.
    n_blocks = whole.sum(axis=1)
    at = np.flatnonzero(whole)
    row, column = np.divmod(at, whole.shape[1])
    place = np.arange(len(at)) + row
    string = np.ones(len(at) + len(texts) + 1, dtype=np.int64)
    string[place] = symbol + 2
    string[-1] = 0
    order = suffix_array(string)
    left = np.zeros(len(string), dtype=np.int64)  # whole blocks from here on
    left[place] = np.repeat(np.cumsum(n_blocks), n_blocks) - np.arange(len(at))
    ahead = np.concatenate([string, np.zeros(INNER, dtype=np.int64)])
    same = np.ones(len(order) - 1, dtype=bool)
    for k in range(INNER):
        same &= ahead[order[1:] + k] == ahead[order[:-1] + k]
    same &= (left[order[1:]] >= INNER) & (left[order[:-1]] >= INNER)
    kind = np.empty(len(string), dtype=np.int64)
    kind[order] = np.cumsum(np.concatenate([[True], ~same]))
    classes = np.zeros(whole.shape, dtype=np.int64)
    classes[row, column] = kind[place]

    stretch = np.repeat(np.arange(len(texts)), starts)
    begin = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts) + (REACH - before)[stretch]
    inner = begin // BLOCK + 1
    head = sums[stretch, inner * BLOCK] - sums[stretch, begin]
    tail = sums[stretch, begin + LENGTH] - sums[stretch, (inner + INNER) * BLOCK]
    key = mix64(classes[stretch, inner].astype(np.uint64) * np.uint64(1 << 20) + begin.astype(np.uint64))
    key = mix64(mix64(key + head) + tail)
    _, at, n = np.unique(key, return_inverse=True, return_counts=True)
    return stretch, n[at] > 1


def _grouped(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by their first column, cut between groups into parts of at least ``least`` rows but for the last."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows > least:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            group = whole.column(0).to_numpy()
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield whole.slice(0, cut)
            held, rows = [whole.slice(cut)], len(group) - cut
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans (key, low, high) that the suffix arrays find in single stretches; groups come together, in order."""
    for big in _grouped(batches, BOUND):
        groups = big.column(0).to_numpy()
        edges = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1], [True]]))
        lo = 0
        while lo < big.num_rows:
            hi = int(edges[max(np.searchsorted(edges, lo + BOUND, side="right") - 1, np.searchsorted(edges, lo, side="right"))])
            part = big.slice(lo, hi - lo)
            lo = hi
            group, before, starts = (part.column(i).to_numpy() for i in (0, 6, 7))
            before, starts = before.astype(np.int64), starts.astype(np.int64)
            stretch, twice = repeated_starts(group, before, starts, part.column(8).to_pylist())
            first = (part.column(5).to_numpy() - before)[stretch] + np.arange(len(stretch)) - (np.cumsum(starts) - starts)[stretch]
            twice &= part.column(3).to_numpy(zero_copy_only=False)[stretch]
            stretch, first = stretch[twice], first[twice]
            if len(first):
                new = np.flatnonzero(np.concatenate([[True], (stretch[1:] != stretch[:-1]) | (first[1:] != first[:-1] + 1)]))
                last = np.concatenate([new[1:], [len(first)]]) - 1
                yield pa.RecordBatch.from_arrays([part.column(4).take(pa.array(stretch[new])), pa.array(first[new]), pa.array(first[last] + LENGTH)],
                                                 names=["key", "low", "high"])


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of groups that are too large, as parts for either half of the strings' starts.

    A start is ``d`` bytes before the anchor, ``low`` <= d < ``high``.  All strings of such a range hold the bytes from
    ``low`` before the anchor to LENGTH - ``high`` + 1 after it; only stretches equal there can share a string.
    """
    for batch in batches:
        out: list[tuple] = []
        for grp, low, high, single, key, place, before, starts, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            middle = (low + high) // 2
            for a, b in ((low, middle), (middle, high)):
                most, least = min(before, b - 1), max(before - starts + 1, a)
                if most < least:
                    continue
                cut = text[before - most:before - least + LENGTH]
                raw = np.frombuffer(cut, dtype=np.uint8)
                sums = prefix_sums(raw)
                core = span_hashes(sums, np.array([most - a]), np.array([most - b + 1 + LENGTH]))
                child = mix64(core + np.uint64(a * 1000 + b) + mix64(np.array([grp], dtype=np.int64).view(np.uint64)))
                out.append((int(child.view(np.int64)[0]), a, b, single, key, place, most, most - least + 1, cut))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), batch.schema, strict=True)], names=batch.schema.names)


def edge_spans(stretches: DataFrame, bound: int = BOUND) -> DataFrame:
    """Spans (key, low, high) of the repeated strings in single stretches; stretches as in ``fetched``."""
    spark = stretches.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spans = spark.createDataFrame([], "key bigint, low bigint, high bigint")
    while True:
        sizes = stretches.groupBy("grp").agg(F.count(F.lit(1)).alias("size"), F.min(F.col("high") - F.col("low")).alias("wide"))
        large = written(sizes.where(F.col("size") > bound), "stretch-large")
        split = not large.isEmpty()
        small = stretches.join(large, "grp", "left_anti").select(*stretches.columns) if split else stretches
        spans = spans.union(written(small.repartition(n, "grp").sortWithinPartitions("grp").mapInArrow(_found, spans.schema), "stretch-spans"))
        if not split:
            return spans
        rest = stretches.join(large, "grp").select(*stretches.columns, "wide")
        # One start left: the group's strings are all equal, and there are many.
        begin = F.col("place") - F.col("before")
        spans = spans.union(written(rest.where("wide = 1 AND single").select("key", begin.alias("low"), (begin + LENGTH).alias("high")), "stretch-equal"))
        stretches = written(rest.where("wide > 1").drop("wide").mapInArrow(_halves, stretches.schema), "stretch-halves")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(key, low, high): bytes of docs (key, text) that repeated strings cover; spans may overlap."""
    bounded_batches(docs.sparkSession)
    anchors = written(anchor_rows(docs), "anchors")
    twice = written(anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "anchor-grams")
    shared = written(anchors.join(twice, "gram"), "anchor-shared")
    kinds = written(shared.groupBy("gram", "stretch").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "place", "before", "starts")).alias("one")), "anchor-kinds")
    whole = shared.join(kinds.where("n > 1").select("gram", "stretch"), ["gram", "stretch"], "left_semi")
    begin = F.col("place") - F.col("before")
    spans = whole.select("key", begin.alias("low"), (begin + F.col("starts") + (LENGTH - 1)).alias("high"))
    open_grams = written(kinds.where("n = 1").select("gram").distinct(), "anchor-open")
    members = kinds.join(open_grams, "gram", "left_semi").select(
        "one.key", F.struct("gram", (F.col("n") == 1).alias("single"), "one.place", "one.before", "one.starts").alias("w"))
    wanted = members.groupBy("key").agg(F.collect_list("w").alias("wanted"))  # of one text: as many as it has anchors
    return spans.union(edge_spans(written(fetched(docs, wanted), "stretches")))


def without_repeats(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``kept`` (bytes), ``n_bytes``, ``n_removed`` and ``n_spans``."""
    made = [T.StructField("kept", T.BinaryType()), *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans"))]
    keep = [c for c in (docs.columns if carry is None else carry) if c not in {f.name for f in made}]
    keyed = _key(docs.select(*dict.fromkeys([*keep, text])))
    spans = repeated_spans(keyed.select(F.col("__key").alias("key"), F.col(text).alias("text")))
    spans = spans.groupBy(F.col("key").alias("__of")).agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("__spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, found = (batch.column(batch.schema.get_field_index(c)) for c in (PACKED, "__spans"))
            for lo in range(0, batch.num_rows, 256):
                out: list[tuple[bytes, int, int, int]] = []
                for raw, marks in zip(unpack_texts(packed.slice(lo, 256)), found.slice(lo, 256), strict=True):
                    out.append(_cut(raw, marks.values) if marks.is_valid else (raw, len(raw), 0, 0))
                rest = [batch.column(batch.schema.get_field_index(c)).slice(lo, 256) for c in keep]
                yield pa.RecordBatch.from_arrays(rest + [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.binary(), *[pa.int64()] * 3), strict=True)],
                                                 names=[*keep, *(f.name for f in made)])

    fields = [keyed.schema[c] for c in keep]
    joined = pack_texts(keyed, text, [*keep, "__key"]).join(spans, F.col("__key") == F.col("__of"), "left").drop("__of", "__key")
    return joined.mapInArrow(cut, T.StructType(fields + made))


def _cut(raw: bytes, spans: pa.StructArray) -> tuple[bytes, int, int, int]:
    """What is left of a text without the spans, which come in order of their beginnings; and the counts."""
    low, high = spans.field("low").to_numpy(), spans.field("high").to_numpy()
    reach = np.maximum.accumulate(high)
    new = np.flatnonzero(np.concatenate([[True], low[1:] > reach[:-1]]))
    low, high = low[new], reach[np.concatenate([new[1:], [len(reach)]]) - 1]
    kept = b"".join(raw[a:b] for a, b in zip([0, *high.tolist()], [*low.tolist(), len(raw)], strict=True))
    return kept, len(raw), len(raw) - len(kept), len(low)
