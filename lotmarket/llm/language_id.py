"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features: letters are lower-cased, every other character counts as a space, and character n-grams of 1 to ``ORDERS``
code points are hashed to ``BUCKETS`` slots.  A slot's value is (1 + ln count) * idf, the row scaled to length 1.

-   ``document_frequencies`` counts slots over all rows that may be learnt from; idf follows from these counts.
-   The classifier is fitted on a bounded sample: about ``per_language`` rows of each language, drawn by seeded random
    numbers.  Training is follow-the-regularised-leader with elastic-net penalties (``L1``, ``L2``), so that most weights
    are exactly 0.  Each of ``SHARDS`` tasks passes its share of the sample, beginning from the common state; after each
    of ``EPOCHS`` passes the shards' states are averaged.
-   A fifth of the sample, of languages with ``LEAST_ASIDE`` sampled rows or more, is kept out of training and fits one temperature, by which the scores are calibrated.
-   Prediction maps every row by its whole text; there is no shuffle.

Nulls and edge cases: a text that is null or has no letter is ``und`` with score 0; rows without a language aren't
learnt from; with nothing to learn from every row is ``und``; repeated rows get equal predictions; further columns are
ignored in learning, and ``predict`` keeps those of its input, replacing ones with a result column's name.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotmarket.llm.common import bounded_batches, histogram, mix64, text_steps, written

ORDERS = 3
BUCKETS = 1 << 16
SHARDS = 4
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.02
UNDETERMINED = "und"
#: Sampled rows from which a language's rows are put aside too; of fewer, all are trained on.
LEAST_ASIDE = 20


def _letters() -> np.ndarray:
    """Per code point of the basic plane: its lower-case letter, or a space."""
    out = np.full(1 << 16, 32, dtype=np.uint32)
    for c in range(1 << 16):
        if chr(c).isalpha():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


_TABLE: list[np.ndarray] = []


def slots_of(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Each text's n-gram slots, with repetitions, sorted."""
    if not _TABLE:
        _TABLE.append(_letters())
    gap = " " * (ORDERS - 1)
    joined = gap + "".join((x or "") + gap for x in texts)
    code = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)
    code = np.where(code < 1 << 16, _TABLE[0][np.minimum(code, (1 << 16) - 1)], code).astype(np.uint64)
    hashed, running = [], np.zeros(len(code), dtype=np.uint64)
    for n in range(ORDERS):
        running = running[:len(code) - n] * np.uint64(0x9E3779B97F4A7C15) + code[n:] + np.uint64(n + 1)
        hashed.append((mix64(running) >> np.uint64(48)).astype(np.uint16))
    lo = 0
    for x in texts:
        hi = lo + len(x or "") + ORDERS - 1  # the gap before a text belongs to it
        yield np.sort(np.concatenate([h[lo:min(hi, len(h))] for h in hashed]))
        lo = hi


def _counted(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
    return slots[new].astype(np.int64), np.diff(np.concatenate([new, [len(slots)]]))


def vectors(texts: list[str | None], idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each text's slots and their TF-IDF values, of length 1."""
    for slots in slots_of(texts):
        at, count = _counted(slots)
        value = (1 + np.log(count)) * idf[at]
        yield at, value / np.sqrt(value @ value)


def document_frequencies(docs: DataFrame) -> np.ndarray:
    def slots(step: pa.RecordBatch) -> np.ndarray:
        each = [_counted(s)[0] for s in slots_of(step.column(0).to_pylist())]
        return np.concatenate(each) if each else np.empty(0, np.int64)

    return histogram(docs.select("text"), slots, BUCKETS)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The regularised leader: 0 where the penalised gradient sum is within L1."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, texts: list[str | None]) -> np.ndarray:
        return np.array([self.weights[at].T @ x + self.bias for at, x in vectors(texts, self.idf)]).reshape(-1, len(self.languages))


def _pass(batches: Iterator[pa.RecordBatch], languages: list[str], idf: np.ndarray, z: np.ndarray, n: np.ndarray) -> None:
    """One shard's pass in place; the last slot of z and n is the bias."""
    place = {x: k for k, x in enumerate(languages)}
    for step in text_steps(batches, "text"):
        truth = step.column(step.schema.get_field_index("lang")).to_pylist()
        texts = step.column(step.schema.get_field_index("text")).to_pylist()
        for (at, x), lang in zip(vectors(texts, idf), truth, strict=True):
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)
            w = _weights(z[at], n[at])
            error = _softmax(x @ w)
            error[place[lang]] -= 1
            g = np.outer(x, error)
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g


def fit(learnable: DataFrame, per_language: int = 2000) -> Model | None:
    """The model from all rows (text, lang) that may be learnt from; None if there are none."""
    rows = learnable.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("text", "lang")
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        return None
    languages = sorted(totals)
    df = document_frequencies(rows)
    idf = np.log((1 + sum(totals.values())) / (1 + df.astype(np.float64))) + 1

    share = sum((F.when(F.col("lang") == x, min(1.0, per_language / totals[x])).otherwise(0.0) for x in languages), F.lit(0.0))
    # Drawn row by row and written at once: copies of one text are drawn one by one, and no later job draws anew.
    many = F.col("lang").isin([x for x in languages if min(totals[x], per_language) >= LEAST_ASIDE])
    sample = written(rows.where(F.rand(1) < share).withColumn("aside", (F.rand(2) < 0.2) & many).withColumn(
        "shard", F.floor(F.rand(3) * SHARDS)), "lang-sample")
    shards = written(sample.where(~F.col("aside")).repartition(SHARDS, "shard"), "lang-shards")
    z, n = np.zeros((2, BUCKETS + 1, len(languages)))
    for _ in range(EPOCHS):
        state = shards.sparkSession.sparkContext.broadcast((idf, z.astype(np.float32), n.astype(np.float32)))

        def run(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            idf, z, n = (x.astype(np.float64) for x in state.value)
            _pass(batches, languages, idf, z, n)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((z.astype(np.float32), n.astype(np.float32)))], pa.binary())], names=["state"])

        # SHARDS states of fixed size
        states = [pickle.loads(r["state"]) for r in shards.coalesce(SHARDS).mapInArrow(run, "state binary").collect()]
        z, n = (np.mean([s[i] for s in states], axis=0, dtype=np.float64) for i in range(2))
    w = _weights(z, n)
    model = Model(languages, idf, w[:-1], w[-1])
    held = sample.where(F.col("aside"))
    model.temperature = _temperature(held, model)
    return model


def _temperature(held: DataFrame, model: Model) -> float:
    """The temperature of least mean log loss on the held rows, by golden section over its logarithm."""
    shared = held.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in text_steps(batches, "text"):
            logits = shared.value.logits(step.column(step.schema.get_field_index("text")).to_pylist())
            yield pa.RecordBatch.from_arrays([step.column(step.schema.get_field_index("lang")), pa.array(list(logits), pa.list_(pa.float64()))], names=["lang", "logits"])

    rows = held.mapInArrow(run, "lang string, logits array<double>").collect()  # a fifth of the bounded sample
    if not rows:
        return 1.0
    logits = np.array([r["logits"] for r in rows])
    truth = np.array([model.languages.index(r["lang"]) for r in rows])

    def loss(t: float) -> float:
        p = _softmax(logits / np.exp(t))[np.arange(len(truth)), truth]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    lo, hi, golden = -5.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - golden * (hi - lo), lo + golden * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def predict(docs: DataFrame, model: Model | None, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``lang_pred`` and ``score``, its calibrated probability."""
    bounded_batches(docs.sparkSession)
    made = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    keep = [c for c in (docs.columns if carry is None else carry) if c not in ("lang_pred", "score")]
    if model is None:
        return docs.select(*keep, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in text_steps(batches, text):
            texts = step.column(step.schema.get_field_index(text)).to_pylist()
            p = _softmax(shared.value.logits(texts) / shared.value.temperature)
            yield pa.RecordBatch.from_arrays([step.column(step.schema.get_field_index(c)) for c in keep] + [
                pa.array([shared.value.languages[k] for k in p.argmax(axis=1)]), pa.array(p.max(axis=1)), ], names=[*keep, "lang_pred", "score"])

    has_letter = "__has_letter"
    rows = docs.select(*dict.fromkeys([*keep, text]), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias(has_letter))
    keep.append(has_letter)
    out = rows.mapInArrow(run, T.StructType([rows.schema[c] for c in keep] + made))
    named = lambda c, other: F.when(F.col(has_letter), F.col(c)).otherwise(F.lit(other)).alias(c)
    return out.select(*keep[:-1], named("lang_pred", UNDETERMINED), named("score", 0.0))


def held_out(doc_id: Column) -> Column:
    """Whether a document's CRC-32 of its id, as text, leaves 2 modulo 4; such documents are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
