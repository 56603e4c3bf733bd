from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from llm_fixtures import clashing, documents, frame

from lotmarket.llm import suffix_dedup
from lotmarket.llm.anchors import LENGTH
from lotmarket.llm.lyndon_suffixes import suffix_array


@given(st.lists(st.integers(1, 4), max_size=40), st.integers(1, 3))
def test_suffix_array(symbols, times):
    symbols = symbols * times + [0]
    assert suffix_array(np.array(symbols)).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def brute(rows):
    texts = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(t[i:i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
    out = []
    for (i, *_), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, dtype=bool)
        for p in range(len(t) - LENGTH + 1):
            if seen[t[p:p + LENGTH]] > 1:
                gone[p:p + LENGTH] = True
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[:len(t)]).sum()) if t else 0
        out.append((i, len(t), int(gone.sum()), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bound", [2000, 3])
def test_against_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(suffix_dedup, "BOUND", bound)
    monkeypatch.setattr(suffix_dedup.edge_spans, "__defaults__", (bound,))
    got = suffix_dedup.without_repeats(clashing(frame(spark))).collect()
    expected = brute(documents())
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got), key=str) == expected
    assert sum(x[2] > 0 for x in expected) > 20


def test_empty(spark):
    assert suffix_dedup.without_repeats(frame(spark, [])).collect() == []


def test_query_columns_agree(spark):
    from hashlib import sha256

    from lotmarket.llm.suffix_query import op10_suffix_dedup
    rows = op10_suffix_dedup(spark, "/root/testdata/sf0.001").collect()
    whole = [r for r in rows if "\ufffd" not in r["kept_text"]]
    assert len(whole) > 100 and all(sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"] for r in whole)
    assert all(r["has_repeats"] == (r["n_removed"] > 0) for r in rows)
