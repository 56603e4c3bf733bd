"""The classifier's training pass and scores against a slow version in plain Python, row by row and weight by weight."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from lotmarket.llm import language_id as L

MASK = (1 << 64) - 1


def slot(chars):
    """The slot of one n-gram."""
    h = 0
    for n, c in enumerate(chars):
        h = (h * 0x9E3779B97F4A7C15 + ord(c) + n + 1) & MASK
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & MASK
    return (h ^ (h >> 31)) >> 48


def counts(text):
    t = "  " + "".join(c.lower() if c.isalpha() else " " for c in text) + "  "
    out = {}
    for i in range(len(text) + 2):
        for n in range(1, L.ORDERS + 1):
            k = slot(t[i:i + n])
            out[k] = out.get(k, 0) + 1
    return out


def vector(text, idf):
    v = {k: (1 + math.log(c)) * idf[k] for k, c in counts(text).items()}
    size = math.sqrt(sum(x * x for x in v.values()))
    return {k: x / size for k, x in v.items()}


def weight(z, n):
    return 0.0 if abs(z) <= L.L1 else -(z - math.copysign(L.L1, z)) / ((L.BETA + math.sqrt(n)) / L.ALPHA + L.L2)


def shares(logits):
    e = [math.exp(x - max(logits)) for x in logits]
    return [x / sum(e) for x in e]


def learn(rows, languages, idf):
    """FTRL-proximal, a state (z, n) for each slot and language; slot BUCKETS is the bias."""
    state = {}
    at = lambda k, j: state.get((k, j), (0.0, 0.0))
    for text, lang in rows:
        v = vector(text, idf) | {L.BUCKETS: 1.0}
        w = {(k, j): weight(*at(k, j)) for k in v for j in range(len(languages))}
        p = shares([sum(w[k, j] * x for k, x in v.items()) for j in range(len(languages))])
        for j, name in enumerate(languages):
            error = p[j] - (name == lang)
            for k, x in v.items():
                z, n = at(k, j)
                g = x * error
                state[k, j] = (z + g - (math.sqrt(n + g * g) - math.sqrt(n)) / L.ALPHA * w[k, j], n + g * g)
    return state


def test_pass_and_scores():
    rng = random.Random(2)
    words = {"aa": ["Ala", "bal", "kal-la", "Öla"], "bb": ["zig", "ziz!", "Gig", "éz"], "cc": ["mum", "num", "unu"]}
    rows = [(" ".join(rng.choice(words[x]) for _ in range(rng.randrange(1, 9))), x) for x in rng.choices(list(words), k=25)]
    languages = sorted(words)
    idf = 1 + np.random.default_rng(1).random(L.BUCKETS)
    z, n = np.zeros((2, L.BUCKETS + 1, len(languages)))
    batch = pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows]), pa.array([x for _, x in rows])], names=["text", "lang"])
    L._pass(iter([batch.slice(0, 10), batch.slice(10)]), languages, idf, z, n)
    state = learn(rows, languages, idf)
    for (k, j), (a, b) in state.items():
        assert z[k, j] == pytest.approx(a, abs=1e-9) and n[k, j] == pytest.approx(b, abs=1e-9)
    assert int((n > 0).sum()) <= len(state)
    w = L._weights(z, n)
    assert 0 < np.mean(w[n > 0] == 0) < 1, "some weights are exactly 0"
    model = L.Model(languages, idf, w[:-1], w[-1], 0.7)
    texts = ["Ala bal", "zig zag", "mum", "?!", "x" * 400]
    got = L._softmax(model.logits(texts) / model.temperature)
    for t, row in zip(texts, got, strict=True):
        v = vector(t, idf) | {L.BUCKETS: 1.0}
        slow = shares([sum(weight(*state.get((k, j), (0.0, 0.0))) * x for k, x in v.items()) / 0.7 for j in range(3)])
        assert row.tolist() == pytest.approx(slow, abs=1e-9)
