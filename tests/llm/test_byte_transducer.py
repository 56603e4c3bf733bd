import re
from collections import Counter
from itertools import permutations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import clashing, documents, frame, words

from lotmarket.llm import byte_transducer as B

LABELS = "doc_id bigint, quality int, toxic int"


def run(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    out = B.transduce(np.frombuffer(b"".join(raw), np.uint8), offsets)
    return [tuple(int(out[c][i]) for c in B.COUNTS) for i in range(len(texts))]


def expected(t):
    w = words(t)
    return len(w), len(set(w)), len(re.findall("[A-Z]", t)), len(t), len(re.findall(r"[#$%&*|]", t))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbZé€😀 \n\t\x0b#|x"), max_size=40), max_size=6))
def test_transducer(texts):
    assert run(texts) == [expected(t) for t in texts]


def test_long_words_and_forced_collisions(monkeypatch):
    texts = ["a" * 64 + " " + "a" * 65 + " " + "a" * 64, "", "x" * 500 + " " + "x" * 500 + " " + "x" * 499 + "y", " ".join(f"w{i % 97}" for i in range(700))]
    assert run(texts) == [expected(t) for t in texts]
    monkeypatch.setattr(B.SpanTable, "hashes", lambda self: np.zeros(len(self.start), np.uint64))  # every word probes
    assert run(texts) == [expected(t) for t in texts]


def brute(rows, labels):
    fails = []
    for i, text, lang, *_ in rows:
        t = text or ""
        n, distinct, upper, chars, signs = expected(t)
        copy = i is not None and any(j is not None and j < i and (u or "") == t for j, u, *_ in rows)
        f = {"A": n < 100, "B": 100 * distinct < 80 * n, "C": 100 * upper > 10 * chars, "D": signs > 0, "E": copy}
        mine = [x for x in labels if x[0] == i and i is not None]
        fails.append((lang or "", {k for k, v in f.items() if v}, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out, shapley = {}, Counter()
    for part in {p for p, *_ in fails}:
        docs = [x for x in fails if x[0] == part]
        for p in permutations("ABCDE"):
            alive = docs
            for k, x in enumerate(p):
                here = [d for d in alive if x in d[1]]
                row = [sum(x not in d[1] for d in alive), len(here), sum(x in d[1] for d in docs) - len(here),
                       sum(d[1] == {x} for d in docs), sum(d[2] for d in here), sum(d[3] for d in here)]
                shapley[part, x] += len(here)
                out[part, "".join(p), k + 1] = row
                alive = [d for d in alive if x not in d[1]]
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_against_brute_force(spark):
    rows = [(i, t, [None, "en", "de", ""][k % 4], s, n) for k, (i, t, _, s, n) in enumerate(documents())]
    rows += [(900 + k, "SHOUT " * k + "a # b " * (k % 2), "fr", None, None) for k in range(40)]
    rows += [(2000 + k, rows[6][1], "en", None, None) for k in range(30)]
    labels = [(i, k % 2, int(k % 7 == 0)) for k, (i, *_) in enumerate(rows) if k % 3] + [(2000, 1, 1), (2000, 0, 0), (2001, None, None), (None, 1, 1)]
    out = B.audit(clashing(frame(spark, rows)), clashing(spark.createDataFrame(labels, LABELS)))
    assert out.columns == NAMES
    got = sorted(tuple(r[c] for c in NAMES) for r in out.collect())
    assert got == brute(rows, labels) and len(got) == 4 * 600


def test_empty_and_null_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert B.audit(frame(spark, []), none).collect() == []
    rows = [(i, None, None, None, None) for i in range(3)]
    got = B.audit(frame(spark, rows), none).collect()
    assert sorted(tuple(r[c] for c in NAMES) for r in got) == brute(rows, [])
