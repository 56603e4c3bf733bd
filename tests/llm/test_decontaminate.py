import math
import random
from collections import Counter

from llm_fixtures import clashing, frame, prose
import numpy as np

from lotmarket.llm import decontaminate


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def planted():
    rng = random.Random(5)
    bench = [(i, prose(rng, 20 + 3 * i, 5000)) for i in range(12)] + [(50, None), (51, ""), (52, "two words"), (53, "Alpha beta, gamma delta epsilon.")]
    docs, truth = [], set()
    for i in range(40):
        k = i % 16
        inside = bench[k][1] or ""
        shown = inside.upper().replace(" ", ",  ") if i % 3 == 0 else inside
        docs.append((i, prose(rng, 80, 5000) + "\n" + shown + " " + prose(rng, 50, 5000), None, None, None))
        if len(inside.split()) >= 5:
            truth.add((i, bench[k][0]))
    docs += [(100 + i, prose(rng, 200, 5000), None, None, None) for i in range(20)]
    docs += [(200, "Two, WORDS!", None, None, None), (201, None, None, None, None), (202, "", None, None, None), (None, bench[2][1], None, None, None), docs[0]]
    return bench, docs, truth | {(200, 52), (None, 2)}


def test_planted_items_and_nothing_else(spark):
    bench, docs, truth = planted()
    got = decontaminate.matches(clashing(frame(spark, docs)), items(spark, bench)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == truth
    assert all(r["similarity"] >= 0.8 and r["distance"] <= decontaminate.RADIUS for r in got)
    assert sum(r["doc_id"] == 0 for r in got) == 2  # a repeated row is reported twice
    kept = decontaminate.without(frame(spark, docs), decontaminate.matches(frame(spark, docs), items(spark, bench)))
    assert {r["doc_id"] for r in kept.collect()} == {d[0] for d in docs} - {i for i, _ in truth} | {None}


def test_slices_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 500)
    bench, docs, truth = planted()
    got = decontaminate.matches(frame(spark, docs), items(spark, bench)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == truth


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(0)
    hashes = [rng.integers(0, 2**63, 20).astype(np.uint64) for _ in range(50)]
    part = decontaminate.Slice(np.arange(50), np.full(50, 24), hashes, [np.ones(20)] * 50, 1.0)
    index = decontaminate.Index(part)
    prints = index.prints[rng.integers(0, 50, 300)] ^ np.packbits(rng.random((300, 64)) < 0.2, axis=1)
    distance = np.unpackbits(prints[:, None] ^ index.prints[None], axis=2).sum(axis=2)
    window, item, d = next(iter([index.near(24, prints)]))
    assert set(zip(window.tolist(), item.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(distance <= decontaminate.RADIUS))))
    assert (d == distance[window, item]).all()
    others = np.packbits(rng.random((2000, 64)) < 0.5, axis=1)
    assert len(index.meet(24, others)[0]) < 0.06 * len(others) * 50  # the index selects: few random pairs meet


def test_empty(spark):
    bench, docs, _ = planted()
    assert decontaminate.matches(frame(spark, []), items(spark, bench)).collect() == []
    assert decontaminate.matches(frame(spark, docs), items(spark, [])).collect() == []


def test_documents_shorter_than_their_item(spark):
    rng = random.Random(8)
    bench = [(i, prose(rng, 30 + 3 * i, 5000)) for i in range(12)]
    docs, truth = [], set()
    for i, text in bench:
        words = text.split()
        docs += [(2 * i, " ".join(words[:-1])), (2 * i + 1, " ".join(words[2:]).upper())]
        truth |= {(2 * i, i, len(words) - 1), (2 * i + 1, i, len(words) - 2)}
    docs += [(100, " ".join(bench[0][1].split()[:15])), (101, " ".join(bench[0][1].split()[:4]))]
    got = decontaminate.matches(frame(spark, [(i, t, None, None, None) for i, t in docs]), items(spark, bench)).collect()
    assert {(r["doc_id"], r["item_id"], r["n_words"]) for r in got} == truth and all(r["first_word"] == 0 for r in got)
    kept = decontaminate.without(frame(spark, [(i, t, None, None, None) for i, t in docs]), spark.createDataFrame(got))
    assert {r["doc_id"] for r in kept.collect()} == {100, 101}


def brute(bench, docs):
    """{(doc, item): best similarity} of all windows of all documents that are at least 0.8, by counters."""
    def shingles(words):
        return Counter(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4)))

    grams = {i: shingles(t.split()) for i, t in bench}
    df = Counter(g for x in grams.values() for g in x)
    weight = lambda g: math.log1p(len(bench) / df[g]) if g in df else math.log1p(len(bench))
    out = {}
    for d, t in docs:
        words = t.split()
        for i, text in bench:
            n = len(text.split())
            for begin in range(max(1, len(words) - n + 1)):
                a, b = shingles(words[begin:begin + n]), grams[i]
                s = sum(weight(g) * c for g, c in (a & b).items()) / sum(weight(g) * c for g, c in (a | b).items())
                if s >= 0.8:
                    out[d, i] = max(s, out.get((d, i), 0))
    return out


def edited():
    """Items, alone and with a shared template or a repeated word, and documents with single changes in them, some cut short."""
    rng = random.Random(11)
    template = prose(rng, 120, 5000).replace(".", "").split()
    bench = [prose(rng, 49 + i % 11, 5000).replace(".", "").split() for i in range(30)]
    bench += [template + prose(rng, 12 + i % 3, 5000).replace(".", "").split() for i in range(20)]
    bench += [prose(rng, 22, 5000).replace(".", "").split() + [f"same{i}"] * 10 + prose(rng, 22, 5000).replace(".", "").split() for i in range(10)]
    docs = []
    for k in range(3):
        for i, item in enumerate(bench):
            words = list(item)
            lo = 120 if 30 <= i < 50 else 0
            words[rng.randrange(lo, len(words))] = "changed"
            if i >= 50:
                words = ["other" if w.startswith("same") else w for w in words]
            if k == 2:
                words = words[:-1]
            else:
                words = prose(rng, 20, 5000).replace(".", "").split() + words + prose(rng, 20, 5000).replace(".", "").split()
            docs.append((k * 100 + i, " ".join(words)))
    return [(i, " ".join(x)) for i, x in enumerate(bench)], docs


def test_recall_as_by_brute_force(spark):
    bench, docs = edited()
    truth = brute(bench, docs)
    assert sum(s < 0.9 for s in truth.values()) > 60
    got = decontaminate.matches(frame(spark, [(i, t, None, None, None) for i, t in docs]), items(spark, bench)).collect()
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in got}
    assert set(found) == set(truth), (len(set(truth) - set(found)), len(truth))
    assert all(abs(found[k] - truth[k]) < 1e-6 for k in truth)
    alone = [r["distance"] <= decontaminate.RADIUS for r in got if r["similarity"] < 0.9]
    assert sum(alone) >= 0.9 * len(alone)  # what the index finds without the second search


def test_recall_of_the_index_alone_at_the_threshold():
    """Items and windows of similarity 0.8 to 0.9, of even and of uneven weights: within RADIUS of each other."""
    rng = np.random.default_rng(4)
    for shared, own, gone in ((0, 50, 5), (150, 30, 5), (600, 20, 10), (600, 10, 9)):
        weights = np.concatenate([np.full(shared, np.log1p(1.0)), np.full(own, np.log1p(200.0))])
        hits = 0
        for _ in range(200):
            a = rng.integers(0, 2**63, shared + own).astype(np.uint64)
            b = a.copy()
            b[shared:shared + gone] = rng.integers(0, 2**63, gone)
            sides = [decontaminate._packed(decontaminate._sums(x, weights)[-1:]) for x in (a, b)]
            hits += np.unpackbits(sides[0] ^ sides[1]).sum() <= decontaminate.RADIUS
        lost = weights[shared:shared + gone].sum()
        similarity = (weights.sum() - lost) / (weights.sum() + lost)
        assert 0.8 <= similarity < 0.9 and hits >= 180, hits


def test_items_beyond_the_radius_are_found(monkeypatch):
    monkeypatch.setattr(decontaminate.Index, "near", lambda self, length, prints: (np.empty(0, np.int64),) * 3)  # SimHash finds none
    own = np.arange(20, dtype=np.uint64)
    index = decontaminate.Index(decontaminate.Slice(np.arange(1), np.array([24]), [own], [np.ones(20)], 1.0))
    weights, has = np.ones(18, np.float32), np.ones(18, dtype=bool)
    assert [(x[0], x[1], x[2], round(x[4], 6)) for x in index.row(own[2:], weights, has, 22)] == [(0, 0, 22, 0.9)]


def test_rows_go_by_their_own_text(spark):
    rng = random.Random(3)
    bench, clean = [(1, prose(rng, 40, 5000))], prose(rng, 60, 5000)
    docs = frame(spark, [(i, t, None, None, None) for i, t in [(7, bench[0][1]), (7, clean), (None, bench[0][1]), (None, clean), (8, None)]])
    kept = decontaminate.without(docs, decontaminate.matches(docs, items(spark, bench)), unnamed=True).collect()
    assert {(r["doc_id"], r["text"]) for r in kept} == {(7, clean), (None, clean), (8, None)} and len(kept) == 3
