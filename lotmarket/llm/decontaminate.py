"""Benchmark decontamination by SimHash over item-sized windows.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased, so case and ASCII punctuation don't count.
A benchmark item of L words is compared with every window of L words of every document, and with the whole of a
document that has fewer words:

1.  What a window has in common with an item are shingles of the benchmark, so windows are looked at only if shingles of
    the slice make up at least 0.8 of their weight (a bit table, then a sorted search, then running sums).  This loses
    nothing.
2.  Each such window gets a 64-bit SimHash of its five-word shingles, from sums of signed square roots of their weights.
    A shingle's weight is its rarity among the items (``log(1 + items / items with the shingle)``); with square roots
    the angle between fingerprints is bounded by the similarity, however uneven the weights are.
3.  A multi-index finds the items within ``RADIUS`` bits: fingerprints are cut into ``BLOCKS`` blocks of 16 bits.  Two
    fingerprints within RADIUS differ in at most RADIUS // BLOCKS = 3 bits of some block; items are listed under all
    block values within ``LISTED`` bits of their own and windows ask for all within ``PROBED`` bits of theirs, together
    3, so the search misses none of these.  About 4 of 100 random pairs meet.
4.  Items beyond RADIUS are found by their own rarest shingles: an item is posted under so many of them that the others
    weigh less than 0.8 of it, so a similar window has at least one.  A bound from sums of the common shingles leaves
    the windows that may be similar.  This loses nothing either.
5.  Candidates of both ways are verified by the exact weighted Jaccard similarity of the shingle multisets.

So the result is that of comparing all windows with all items, but for equal hashes of different shingles.

Documents are only read and mapped: no shuffle, and a lost task is run again.  The benchmark goes to the tasks in
slices of at most ``SLICE_BYTES`` of text, each one pass over the documents, so that what is broadcast has a bound; an
item longer than that is a slice of its own.

At a similarity of 0.8 a window without repeated shingles has a cosine of at least 8/9 to the item, a SimHash distance
of 9.7 bits in the mean with a deviation of 2.9, so nearly all are within RADIUS; equal windows have distance 0.  Rows
that step 4 adds have their true distance, above RADIUS.

Nulls and edge cases: a null or empty text has no window, a null or empty item matches nothing; an item of one to four
words matches only a document of just these words; repeated rows are reported each; empty tables give no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmarket.llm.common import bounded_batches, list_array, mix64, text_bytes, text_steps, written
from lotmarket.llm.shingles import shingle_hashes, word_hashes

SHINGLE = 5
BLOCKS, BLOCK_BITS = 4, 16
RADIUS = 15
LISTED, PROBED = 2, 1
SIMILARITY = 0.8
#: For sums of weights, which are rounded: what has less than this share in common is surely not similar.
LEAST = SIMILARITY * (1 - 1e-4)
SLICE_BYTES = 8 << 20
#: Bits of the table that tells where a shingle of the benchmark may be.
GATE_BITS = 22
#: Windows, and pairs of a window and an item, that are looked at in one step.
WINDOWS, PAIRS = 1 << 12, 1 << 20

_FLIPS = {r: np.array([m for m in range(1 << BLOCK_BITS) if m.bit_count() <= r], dtype=np.uint16) for r in (LISTED, PROBED)}
_POPULATION = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def _signs(hashes: np.ndarray) -> np.ndarray:
    """A row of 64 signs for each shingle."""
    bits = np.unpackbits(mix64(hashes).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.float32) * 2 - 1


def _sums(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Running sums, from 0, of the signs of shingles times the square roots of their weights."""
    sums = np.zeros((len(hashes) + 1, 64), dtype=np.float64)
    np.cumsum(_signs(hashes) * np.sqrt(weights, dtype=np.float32)[:, None], axis=0, out=sums[1:])
    return sums


def _packed(sums: np.ndarray) -> np.ndarray:
    """The eight bytes of the fingerprints of rows of 64 weighted sums; a sum within rounding of 0 is 0."""
    return np.packbits(sums > 1e-3, axis=1)


def _slots(prints: np.ndarray, bits: int) -> np.ndarray:
    """For each fingerprint, (block, value) as one number of all values within so many bits of each block's own."""
    value = prints.view(np.uint16)[:, :, None] ^ _FLIPS[bits]
    return (np.arange(BLOCKS, dtype=np.int32)[:, None] << BLOCK_BITS | value).reshape(len(prints), -1)


@dataclass
class Slice:
    """Some items: their ids, lengths in words, and shingles on end, with weights."""

    ids: np.ndarray
    lengths: np.ndarray
    hashes: list[np.ndarray]
    weights: list[np.ndarray]
    other_weight: float


class Index:
    """Finds a slice's items in windows of documents; built on a worker."""

    def __init__(self, items: Slice):
        self.items = items
        self.known, first = np.unique(np.concatenate(items.hashes), return_index=True)
        self.known_weights = np.concatenate(items.weights)[first].astype(np.float32)
        self.gate = np.zeros(1 << GATE_BITS, dtype=bool)
        self.gate[(self.known >> np.uint64(64 - GATE_BITS)).astype(np.int64)] = True
        prints = np.concatenate([_packed(_sums(h, w)[-1:])
                                 for h, w in zip(items.hashes, items.weights, strict=True)])
        self.prints = prints
        self.weight = np.array([w.sum() for w in items.weights])
        posts = [(h, np.full(len(h), i)) for i in range(len(items.hashes)) for h in (self._rarest(i),)]
        posted, item = (np.concatenate(x) for x in zip(*posts, strict=True))
        order = np.argsort(posted, kind="stable")
        self.posted, self.posted_item = posted[order], item[order]
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in np.unique(items.lengths):
            own = np.flatnonzero(items.lengths == length).astype(np.int32)
            slots = _slots(prints[own], LISTED)
            item = np.repeat(own, slots.shape[1])
            order = np.argsort(slots, axis=None, kind="stable")
            self.by_length[int(length)] = (slots.ravel()[order], item[order])

    def _rarest(self, item: int) -> np.ndarray:
        """So many of an item's distinct shingles, those of most weight first, that the others are less than LEAST of it."""
        values, first, count = np.unique(self.items.hashes[item], return_index=True, return_counts=True)
        weight = self.items.weights[item][first]
        by = np.lexsort((values, -weight))
        rest = self.weight[item] - np.cumsum((weight * count)[by])
        return values[by[:int(np.argmax(rest < LEAST * self.weight[item])) + 1]]

    def weigh(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The weight of each shingle, and whether an item has it."""
        weights = np.full(len(hashes), self.items.other_weight, dtype=np.float32)
        maybe = np.flatnonzero(self.gate[(hashes >> np.uint64(64 - GATE_BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, hashes[maybe]), len(self.known) - 1)
        hit = self.known[at] == hashes[maybe]
        weights[maybe[hit]] = self.known_weights[at[hit]]
        has = np.zeros(len(hashes), dtype=bool)
        has[maybe[hit]] = True
        return weights, has

    def meet(self, length: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item), each once: items of that length that the windows' fingerprints meet in a slot."""
        slots, listed = self.by_length[length]
        wanted = _slots(prints, PROBED)
        lo = np.searchsorted(slots, wanted.ravel(), side="left")
        n = np.searchsorted(slots, wanted.ravel(), side="right") - lo
        window = np.repeat(np.repeat(np.arange(len(prints)), wanted.shape[1]), n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        return np.divmod(np.unique(window * len(self.prints) + listed[place]), len(self.prints))

    def near(self, length: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all items of that length within RADIUS of the windows' fingerprints."""
        window, item = self.meet(length, prints)
        distance = _POPULATION[prints[window] ^ self.prints[item]].sum(axis=1, dtype=np.int64)
        ok = distance <= RADIUS
        return window[ok], item[ok], distance[ok]

    def similarity(self, hashes: np.ndarray, weights: np.ndarray, item: int) -> float:
        """Weighted Jaccard similarity of a window's and an item's shingle multisets."""
        both = np.concatenate([hashes, self.items.hashes[item]])
        values, at = np.unique(both, return_inverse=True)
        mine = np.bincount(at[:len(hashes)], minlength=len(values))
        theirs = np.bincount(at[len(hashes):], minlength=len(values))
        weight = np.zeros(len(values))
        weight[at[:len(hashes)]] = weights
        weight[at[len(hashes):]] = self.items.weights[item]
        return float((weight * np.minimum(mine, theirs)).sum() / (weight * np.maximum(mine, theirs)).sum())

    def posted_under(self, hashes: np.ndarray) -> np.ndarray:
        """The items that are posted under any of these shingles."""
        values = np.unique(hashes)
        lo, hi = (np.searchsorted(self.posted, values, side=side) for side in ("left", "right"))
        n = hi - lo
        return np.unique(self.posted_item[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)])

    def pairs(self, hashes: np.ndarray, weights: np.ndarray, has: np.ndarray, n: int, at: np.ndarray,
              lengths: list[int]) -> Iterator[tuple[int, int, int]]:
        """(begin, item, distance): pairs of windows and items of the given lengths that may be similar, each once.

        The windows have n shingles each and begin at ``at`` (ascending).
        """
        last = int(at[-1]) + n
        sums = _sums(hashes[at[0]:last], weights[at[0]:last])
        prints = _packed(sums[at - at[0] + n] - sums[at - at[0]])
        seen = []
        for length in lengths:
            own = len(self.by_length[length][1]) // (BLOCKS * len(_FLIPS[LISTED]))  # items; a pair may meet in several slots
            step = max(1, PAIRS // (BLOCKS * len(_FLIPS[PROBED]) * own))
            for lo in range(0, len(at), step):
                window, item, distance = self.near(length, prints[lo:lo + step])
                window = at[window + lo]
                seen.append(window * len(self.prints) + item)
                yield from zip(window.tolist(), item.tolist(), distance.tolist(), strict=True)
        seen = np.concatenate(seen)
        inside = np.flatnonzero(has[at[0]:last]) + int(at[0])
        total = np.concatenate([[0.0], np.cumsum(weights[at[0]:last], dtype=np.float64)])
        total = total[at - at[0] + n] - total[at - at[0]]
        items = self.posted_under(hashes[inside])
        for i in items[np.isin(self.items.lengths[items], lengths)]:
            own = inside[np.isin(hashes[inside], self.items.hashes[i])]
            common = np.concatenate([[0.0], np.cumsum(weights[own], dtype=np.float64)])
            common = common[np.searchsorted(own, at + n)] - common[np.searchsorted(own, at)]
            common = np.minimum(common, self.weight[i])  # at least what they have in common
            begin = at[common >= LEAST * (self.weight[i] + total - common)]
            begin = begin[~np.isin(begin * len(self.prints) + i, seen)]
            far = _POPULATION[prints[np.searchsorted(at, begin)] ^ self.prints[i]].sum(axis=1, dtype=np.int64)
            yield from ((int(x), int(i), int(d)) for x, d in zip(begin, far, strict=True))

    def row(self, hashes: np.ndarray, weights: np.ndarray, has: np.ndarray, n_words: int) -> Iterator[tuple[int, int, int, int, float]]:
        """For one document: (item, first word, words, distance, similarity) of each item's best window, the first of equals."""
        hits = np.flatnonzero(has)
        widest = max(self.by_length)
        best: dict[int, tuple[float, int, int]] = {}

        def look(n: int, at: np.ndarray, lengths: list[int]) -> None:
            for begin, i, d in self.pairs(hashes, weights, has, n, at, lengths):
                s = self.similarity(hashes[begin:begin + n], weights[begin:begin + n], i)
                if s >= SIMILARITY and (-s, begin) < best.get(i, (0.0, 0, 0))[:2]:
                    best[i] = (-s, begin, d)

        longer = [x for x in self.by_length if x > n_words >= SHINGLE]
        if longer and weights[has].sum(dtype=np.float64) >= LEAST * weights.sum(dtype=np.float64):
            look(len(hashes), np.zeros(1, dtype=np.int64), longer)
        for part in np.split(hits, np.flatnonzero(np.diff(hits) > 2 * widest) + 1):
            lo = max(0, int(part[0]) - widest)
            hi = min(len(hashes), int(part[-1]) + widest)
            total = np.concatenate([[0.0], np.cumsum(weights[lo:hi], dtype=np.float64)])
            known = np.concatenate([[0.0], np.cumsum(np.where(has[lo:hi], weights[lo:hi], 0), dtype=np.float64)])
            for length in self.by_length:
                n = length - SHINGLE + 1 if length >= SHINGLE else 1  # shingles in the window
                if length > n_words or (length < SHINGLE) and n_words != length or hi - lo < n:
                    continue
                at = lo + np.flatnonzero(known[n:] - known[:-n] >= LEAST * (total[n:] - total[:-n]))
                for run in np.split(at, np.flatnonzero(np.diff(at) > n) + 1):
                    for k in range(0, len(run), WINDOWS):
                        look(n, run[k:k + WINDOWS], [length])
        for i, (s, begin, d) in best.items():
            yield i, begin, min(n_words, int(self.items.lengths[i])), d, -s


def slices(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[Slice]:
    """The benchmark in slices of about SLICE_BYTES of text each, with the weights of all items' shingles."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in text_steps(batches, "text"):
            words, word_rows, _ = word_hashes(*text_bytes(step.column(1)), plain=True)
            hashes, rows, _ = shingle_hashes(words, word_rows)
            by = np.argsort(rows, kind="stable")
            n = np.bincount(rows, minlength=step.num_rows)
            n_words = np.bincount(word_rows, minlength=step.num_rows)
            yield pa.RecordBatch.from_arrays([step.column(0), pa.array(n_words), list_array(hashes[by].view(np.int64), n)],
                                             names=["item_id", "n_words", "hashes"])

    rows = benchmark.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    n_slices = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SLICE_BYTES))
    items = written(rows.distinct().mapInArrow(shingles, "item_id bigint, n_words bigint, hashes array<bigint>")
                    .where(F.size("hashes") > 0).withColumn("slice", F.pmod(F.xxhash64("item_id", "hashes"), F.lit(n_slices))), "bench-items")
    total = items.count()
    having = items.select(F.explode(F.array_distinct("hashes")).alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("df"))
    weighed = written(items.select("item_id", "n_words", "slice", F.xxhash64("hashes").alias("k"), F.posexplode("hashes").alias("place", "hash")).join(having, "hash")
                      .groupBy("slice", "item_id", "n_words", "k")
                      .agg(F.sort_array(F.collect_list(F.struct("place", "hash", "df"))).alias("shingles")), "bench-weights")
    packed = weighed.select("slice", "item_id", "n_words", F.transform("shingles", lambda x: x["hash"]).alias("hashes"),
                            F.transform("shingles", lambda x: x["df"]).alias("dfs"))
    for k in range(n_slices):
        part = packed.where(F.col("slice") == k).toArrow()  # at most about SLICE_BYTES of text: numbers only, no Python objects
        if part.num_rows:
            hashes, dfs = (part[c].combine_chunks() for c in ("hashes", "dfs"))
            cuts = np.cumsum(hashes.value_lengths().to_numpy())[:-1]
            weights = np.log1p(total / dfs.flatten().to_numpy().astype(np.float64))
            yield Slice(np.array(part["item_id"].to_pylist(), dtype=object), part["n_words"].to_numpy(),
                        np.split(hashes.flatten().to_numpy().view(np.uint64), cuts), np.split(weights, cuts), float(np.log1p(total)))


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, first_word, n_words, distance, similarity, text_hash): each item a document holds, with its best window."""
    spark = docs.sparkSession
    bounded_batches(spark)
    schema = "doc_id bigint, item_id bigint, first_word bigint, n_words bigint, distance int, similarity double, text_hash bigint"
    out = spark.createDataFrame([], schema)
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    for items in slices(benchmark):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value)
            for step in text_steps(batches, "text"):
                words, word_rows, _ = word_hashes(*text_bytes(step.column(1)), plain=True)
                hashes, rows, places = shingle_hashes(words, word_rows)
                by = np.argsort(rows, kind="stable")
                hashes, rows = hashes[by], rows[by]
                weights, has = index.weigh(hashes)
                starts = np.searchsorted(rows, np.arange(step.num_rows + 1))
                n_words = np.bincount(word_rows, minlength=step.num_rows)
                ids, marks, found = step.column(0).to_pylist(), step.column(2).to_pylist(), []
                for r in np.unique(rows[has]):
                    own = slice(starts[r], starts[r + 1])
                    found += [(ids[r], index.items.ids[i], *rest, marks[r]) for i, *rest in index.row(hashes[own], weights[own], has[own], int(n_words[r]))]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (
                        pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int64()), strict=True)],
                        names=["doc_id", "item_id", "first_word", "n_words", "distance", "similarity", "text_hash"])

        out = out.union(docs.mapInArrow(run, schema))
    return out


def without(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text", unnamed: bool = False) -> DataFrame:
    """``docs`` without the rows that ``matches`` reports, by their id and the hash of their text.

    Each row is judged by its own text, also if others share its id.  A row without an id stays, unless ``unnamed``.
    """
    hit = written(found.select(F.col("doc_id").alias("__hit"), F.col("text_hash").alias("__hash")).distinct(), "bench-hits")
    same = F.col(doc_id).eqNullSafe(F.col("__hit")) if unnamed else F.col(doc_id) == F.col("__hit")
    return docs.join(hit, same & (F.xxhash64(text) == F.col("__hash")), "left_anti")
