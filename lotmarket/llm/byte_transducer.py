"""What five filters of a corpus do alone, together and in every order, from one pass over the bytes of each text.

**The pass.**  A finite-state transducer reads UTF-8 bytes.  ``CLASS_OF`` gives each byte's class, ``NEXT`` the state
(between words, in a word) and ``EMIT`` what the step puts out: a word begins or ends, a capital, a symbol, a code point.
The automaton is definite, i.e. the state after a byte depends on that byte's class alone (``NEXT`` has equal rows), so
the steps of all bytes of a batch are looked up at once, with the state set back where a text begins.

**Distinct words.**  The spans that the transducer emits go into an open-addressing hash table.  A span that meets a
taken slot is *verified*: it is the same word only if text, length and all bytes are equal; otherwise it probes on.

**The audit.**  A text's counts give a bit for each filter; whether an equal text with a smaller id exists is found by
counting rows per (text digest, bits, part, labels) first, so a text that a third of all rows share is a few rows before
anything is dealt by it.  Counts per part and set of failed filters (32 at most) then give every order's steps.

Nulls and edge cases: a null text is empty; an empty text has no word (it fails A, not B, C or D); a null part is the
empty string; a row without an id fails no other row and never fails E; rows that repeat an id aren't smaller than each
other; a document without labels is neither good nor toxic, and with several it is what any of them says.  An empty table
has no parts and no rows.  Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotmarket.llm.common import SPACE_CHARS, bounded_batches, mix64, text_bytes, text_steps, written

SYMBOLS = "#$%&*|"
SPACE, UPPER, SYMBOL, CONTINUATION, OTHER = range(5)
BETWEEN, INSIDE = range(2)
BEGINS, ENDS, CAPITAL, SIGN, TRAILS = 1, 2, 4, 8, 16

CLASS_OF = np.full(256, OTHER, dtype=np.uint8)
CLASS_OF[0x80:0xC0] = CONTINUATION
CLASS_OF[ord("A"):ord("Z") + 1] = UPPER
CLASS_OF[[ord(c) for c in SYMBOLS]] = SYMBOL
CLASS_OF[[ord(c) for c in SPACE_CHARS]] = SPACE
#                 SPACE    UPPER             SYMBOL         CONTINUATION     OTHER
NEXT = np.array([[BETWEEN, INSIDE, INSIDE, INSIDE, INSIDE],
                 [BETWEEN, INSIDE, INSIDE, INSIDE, INSIDE]], dtype=np.uint8)
EMIT = np.array([[0, BEGINS | CAPITAL, BEGINS | SIGN, BEGINS | TRAILS, BEGINS],
                 [ENDS, CAPITAL, SIGN, TRAILS, 0]], dtype=np.uint8)
assert (NEXT[BETWEEN] == NEXT[INSIDE]).all(), "all bytes step at once only in a definite automaton"

#: Words up to this many bytes are hashed and compared in lanes of eight; longer ones, which are few, one by one.
LANE_BYTES = 64
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
COUNTS = ("n_words", "n_distinct", "n_upper", "n_chars", "n_symbols")


class SpanTable:
    """An open-addressing table of byte spans of ``raw``; spans of different texts are different."""

    def __init__(self, raw: np.ndarray, owner: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.raw, self.owner, self.start, self.size = raw, owner, start, end - start
        padded = np.concatenate([raw, np.zeros(8, np.uint8)])
        self._at = np.ndarray(len(raw) + 1, dtype="<u8", buffer=padded, strides=(1,))

    def lane(self, spans: np.ndarray, k: int) -> np.ndarray:
        """The k-th eight bytes of each span, zeros behind its end."""
        return self._at[self.start[spans] + 8 * k] & _KEEP[np.minimum(self.size[spans] - 8 * k, 8)]

    def bytes_of(self, span: int) -> bytes:
        return self.raw[self.start[span]:self.start[span] + self.size[span]].tobytes()

    def hashes(self) -> np.ndarray:
        out = mix64(self.owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + self.size.astype(np.uint64))
        short = np.flatnonzero(self.size <= LANE_BYTES)
        for k in range(LANE_BYTES // 8):
            short = short[self.size[short] > 8 * k]
            if not len(short):
                break
            out[short] = mix64(out[short] ^ self.lane(short, k))
        for i in np.flatnonzero(self.size > LANE_BYTES):
            out[i] ^= np.uint64(int.from_bytes(hashlib.blake2b(self.bytes_of(i), digest_size=8).digest(), "little"))
        return out

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans a[i] and b[i] are of one text and equal byte for byte."""
        out = (self.owner[a] == self.owner[b]) & (self.size[a] == self.size[b])
        long = np.flatnonzero(out & (self.size[a] > LANE_BYTES))
        short = np.flatnonzero(out & (self.size[a] <= LANE_BYTES))
        for k in range(LANE_BYTES // 8):
            short = short[self.size[a[short]] > 8 * k]
            if not len(short):
                break
            equal = self.lane(a[short], k) == self.lane(b[short], k)
            out[short[~equal]] = False
            short = short[equal]
        for i in long:
            out[i] = self.bytes_of(a[i]) == self.bytes_of(b[i])
        return out

    def distinct(self) -> np.ndarray:
        """One span of each set of equal ones."""
        n = len(self.start)
        slots = 1 << max(4, int(2 * n).bit_length())
        table = np.full(slots, -1, dtype=np.int64)
        place = (self.hashes() & np.uint64(slots - 1)).astype(np.int64)
        waiting, first = np.arange(n), np.zeros(n, dtype=bool)
        while len(waiting):
            free = waiting[table[place[waiting]] < 0]
            table[place[free]] = free  # of those that claim one slot, one stays
            holder = table[place[waiting]]
            mine = holder == waiting
            first[waiting[mine]] = True
            waiting, holder = waiting[~mine], holder[~mine]
            waiting = waiting[~self.same(waiting, holder)]
            place[waiting] = (place[waiting] + 1) & (slots - 1)
        return np.flatnonzero(first)


def transduce(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text, from all texts' bytes on end and the offsets at which they begin (one more than texts)."""
    n = len(offsets) - 1
    kind = CLASS_OF[raw]
    after = NEXT[BETWEEN][kind]
    before = np.concatenate([np.zeros(1, np.uint8), after])[:len(raw)]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[begins] = BETWEEN
    out = EMIT[before, kind]
    per_text = lambda flag: np.diff(np.searchsorted(np.flatnonzero(out & flag), offsets))
    start = np.flatnonzero(out & BEGINS)
    last = offsets[1:][offsets[:-1] < offsets[1:]]
    end = np.sort(np.concatenate([np.flatnonzero(out & ENDS), last[after[last - 1] == INSIDE]]))
    owner = np.searchsorted(offsets, start, side="right") - 1
    spans = SpanTable(raw, owner, start, end)
    return {"n_words": np.bincount(owner, minlength=n), "n_distinct": np.bincount(owner[spans.distinct()], minlength=n),
            "n_upper": per_text(CAPITAL), "n_chars": np.diff(offsets) - per_text(TRAILS), "n_symbols": per_text(SIGN)}


def measured(docs: DataFrame, carry: Sequence[str], text: str = "text") -> DataFrame:
    """The columns ``carry`` of ``docs``, and ``COUNTS`` of each whole text."""
    carry = list(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in text_steps(batches, text):
            counts = transduce(*text_bytes(step.column(step.schema.get_field_index(text))))
            rest = [step.column(step.schema.get_field_index(c)) for c in carry]
            yield pa.RecordBatch.from_arrays([*rest, *(pa.array(counts[c], pa.int64()) for c in COUNTS)], names=[*carry, *COUNTS])

    bounded_batches(docs.sparkSession)
    rows = docs.select(*dict.fromkeys([*carry, text]))
    schema = T.StructType([*(rows.schema[c] for c in carry), *(T.StructField(c, T.LongType()) for c in COUNTS)])
    return rows.mapInArrow(run, schema)


def own_filters() -> dict[str, Column]:
    """The failure conditions that a text's own counts decide, by letter."""
    words = F.col("n_words")
    return {"A": words < 100, "B": 100 * F.col("n_distinct") < 80 * words,
            "C": 100 * F.col("n_upper") > 10 * F.col("n_chars"), "D": F.col("n_symbols") > 0}


#: The filter for texts that an earlier document has, whose condition is found across the table.
COPY = "E"


def letters() -> str:
    return "".join(own_filters()) + COPY


def _sets(mask: Column) -> dict[str, Column]:
    return {x: mask.bitwiseAND(F.lit(1 << i)) != 0 for i, x in enumerate(letters())}


def failure_counts(docs: DataFrame, labels: DataFrame, part: str = "lang", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the set of filters that they fail, a bit for each letter;
    among them those labelled good and toxic."""
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                       F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("digest"), F.col(text).alias("text"))
    bits = [F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(own_filters().values())]
    rows = written(measured(rows, ["id", "part", "digest"]).select("id", "part", "digest", sum(bits[1:], bits[0]).alias("mask")), "filter-masks")
    said = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        (F.max("quality") == 1).alias("good"), (F.max("toxic") == 1).alias("toxic"))
    no = F.lit(False)
    named = rows.where("id IS NOT NULL").join(said, "id", "left").select(
        *rows.columns, F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
    nameless = rows.where("id IS NULL").withColumn("good", no).withColumn("toxic", no)
    like = ["digest", "mask", "part", "good", "toxic"]
    named = (named.groupBy("id", *like).agg(F.count(F.lit(1)).alias("n"))
             .groupBy(*like).agg(F.sum("n").alias("n"), F.min("id").alias("least"), F.min_by("n", "id").alias("n_least")))
    first = F.col("least") == F.min("least").over(Window.partitionBy("digest"))
    named = named.withColumn("passes", F.when(first, F.col("n_least")).otherwise(0))
    bit = 1 << len(own_filters())
    two = F.explode(F.array(F.struct(F.col("mask"), F.col("passes").alias("n")),
                            F.struct(F.col("mask").bitwiseOR(F.lit(bit)).alias("mask"), (F.col("n") - F.col("passes")).alias("n"))))
    named = named.select("part", "good", "toxic", two.alias("x")).select("part", "good", "toxic", "x.mask", "x.n").where("n > 0")
    nameless = nameless.groupBy("part", "good", "toxic", "mask").agg(F.count(F.lit(1)).alias("n"))
    times = lambda flag: F.sum(F.when(F.col(flag), F.col("n")).otherwise(0)).alias(flag)
    return named.unionByName(nameless).groupBy("part", "mask").agg(F.sum("n").alias("n"), times("good"), times("toxic"))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row for each part, order of the filters and step, see the result columns below."""
    names = letters()
    orders = ["".join(p) for p in permutations(names)]
    counts = failure_counts(docs, labels, part, text, doc_id)
    each = counts.withColumn("filter_order", F.explode(F.lit(orders))).withColumn("step", F.explode(F.lit(list(range(1, len(names) + 1)))))
    at = {x: F.instr("filter_order", x) for x in names}
    fails = _sets(F.col("mask"))
    any_of = lambda test: F.exists(F.array(*[fails[x] & test(at[x]) for x in names]), lambda b: b)
    each = each.select("*", any_of(lambda a: a < F.col("step")).alias("gone"), any_of(lambda a: a == F.col("step")).alias("hit"),
                       F.bit_count("mask").alias("size"))
    total = lambda test, what="n": F.coalesce(F.sum(F.when(test, F.col(what))), F.lit(0)).cast("long")
    here = ~F.col("gone") & F.col("hit")
    # Of the filters that a document fails each is the first in as many of the orders.
    shares = F.sum(F.when(F.col("hit"), F.col("n") * (F.lit(len(orders)) / F.col("size")).cast("long")).otherwise(0)).cast("long")
    return each.groupBy("part", "filter_order", "step").agg(
        total(~F.col("gone") & ~F.col("hit")).alias("kept"), total(here).alias("removed"),
        total(F.col("gone") & F.col("hit")).alias("redundant"), total(F.col("hit") & (F.col("size") == 1)).alias("unique_fails"),
        total(here, "good").alias("good_lost"), total(here, "toxic").alias("toxic_lost"), shares.alias("shapley"))
