from collections import defaultdict

import numpy as np
import pytest
from llm_fixtures import LOWER, clashing, documents, frame, words

from lotmarket.llm import components, jaccard_join


def shingles(text):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    nodes = [(i, shingles(t)) for i, t, *_ in rows]
    root = {k: k for k in range(len(nodes))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(nodes):
        for b, (j, t) in enumerate(nodes[:a]):
            if s and t and i is not None and j is not None and 100 * len(s & t) >= 80 * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = defaultdict(list)
    for k, (i, _) in enumerate(nodes):
        least[find(k)].append(i)
    return sorted(((i, len(s), min(least[find(k)], key=lambda x: (x is None, x))) for k, (i, s) in enumerate(nodes)), key=str)


def linked(spark, rows):
    return sorted((tuple(r) for r in jaccard_join.link(clashing(frame(spark, rows))).collect()), key=str)


def test_against_brute_force(spark):
    assert linked(spark, documents()) == brute(documents())


@pytest.mark.parametrize(("held", "cell"), [(1 << 14, 1 << 9), (3, 2)])
def test_long_posting_lists(spark, monkeypatch, held, cell):
    """With every list of more than two entries long, few neighbours and no hub, the last round must find what is left."""
    monkeypatch.setattr(jaccard_join, "SHORT", 2)
    monkeypatch.setattr(jaccard_join, "NEIGHBOURS", 1)
    monkeypatch.setattr(jaccard_join, "HUBS", 1)
    monkeypatch.setattr(jaccard_join, "HELD", held)
    monkeypatch.setattr(jaccard_join, "CELL", cell)
    rows = documents() + [(1000 + i, t, *rest) for i, (_, t, *rest) in enumerate(documents(2))]
    assert linked(spark, rows) == brute(rows)


def test_one_each(spark):
    rows = documents()
    kept = [tuple(r) for r in jaccard_join.one_each(frame(spark, rows)).collect()]
    stay = {i for i, _, c in brute(rows) if i is not None and i == c}
    assert sorted(r[0] for r in kept if r[0] is not None) == sorted(stay)
    assert sum(r[0] is None for r in kept) == 2


def test_empty(spark):
    assert jaccard_join.link(frame(spark, [])).collect() == []
    assert jaccard_join.one_each(frame(spark, [])).collect() == []


def test_components_of_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(components, "FOREST", 7)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + i, 100) for i in range(30)] + [(7, 7), (3, 2)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_full_sketches_may_link():
    full, half = np.full((1, jaccard_join.SLOTS), 2**16 - 1, dtype=np.uint16), np.full((1, jaccard_join.SLOTS), 100, dtype=np.uint16)
    n = np.array([10_000_000])
    assert jaccard_join._enough(n, n, full, full).tolist() == [True]  # the counts' sum, 8.4 million, is no bound
    assert jaccard_join._enough(np.array([12800]), np.array([12800]), half, half // 2).tolist() == [False]


def _one_list(rng, count, outside):
    """Entries (token, n, place, grp, component, degree, sketch) of one list, ``outside`` of them not in its largest component."""
    rows = []
    for g in range(count):
        n = int(rng.integers(40, 120))
        sketch = np.bincount(rng.integers(0, 6, n), minlength=jaccard_join.SLOTS).astype(np.uint16)
        rows.append((7, n, int(rng.integers(0, 4)), g, g // 3 if g < outside else 10**6, int(rng.integers(0, 9)), sketch.tobytes()))
    return rows


def _pairs_of(rows, probes):
    """Pairs of units that may link, one of them at least among ``probes``, by the filters taken one pair at a time."""
    out = set()
    for _, n, p, g, c, _, s in probes:
        for _, m, q, h, d, _, t in rows:
            one = lambda *v: [np.array([x]) for x in v]
            marks = [np.frombuffer(x, dtype=np.uint16).reshape(1, -1) for x in (s, t)]
            if c != d and jaccard_join._may_link(*one(n, m, p, q))[0] and jaccard_join._enough(*one(n, m), *marks)[0]:
                out.add(frozenset([(g, c), (h, d)]))
    return out


def test_a_list_is_dealt_in_cells(spark, monkeypatch):
    """All pairs with an outer entry, each once, while no cell holds much more of the list than CELL."""
    monkeypatch.setattr(jaccard_join, "CELL", 16)
    rows = _one_list(np.random.default_rng(5), 300, 60)
    entries = spark.createDataFrame(rows, "token bigint, n bigint, place bigint, grp bigint, component bigint, degree bigint, sketch binary")
    got = [frozenset([(r.ga, r.ca), (r.gb, r.cb)]) for r in jaccard_join._cross_pairs(entries).collect()]
    assert len(got) == len(set(got)) and set(got) == _pairs_of(rows, rows[:60]) and len(got) > 100
    mixed = jaccard_join._mixed_lists(entries)
    sizes = jaccard_join._cells(mixed, mixed.where("outer")).groupBy(*jaccard_join._CELL_KEYS).count().collect()
    assert len(sizes) > 20 and max(r["count"] for r in sizes) < 5 * 16


def test_hubs_meet_their_list(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CELL", 16)
    monkeypatch.setattr(jaccard_join, "HUBS", 1)
    rows = _one_list(np.random.default_rng(6), 200, 90)
    entries = spark.createDataFrame(rows, "token bigint, n bigint, place bigint, grp bigint, component bigint, degree bigint, sketch binary")
    got = {frozenset([(r.ga, r.ca), (r.gb, r.cb)]) for r in jaccard_join._hub_pairs(entries).collect()}
    assert got == _pairs_of(rows, [max(rows, key=lambda r: (r[5], r[3], r[4]))])


def test_lists_of_one_component_give_nothing(spark):
    rows = _one_list(np.random.default_rng(7), 20, 0)
    entries = spark.createDataFrame(rows, "token bigint, n bigint, place bigint, grp bigint, component bigint, degree bigint, sketch binary")
    assert jaccard_join._cross_pairs(entries).collect() == [] and jaccard_join._hub_pairs(entries).collect() == []
