import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from llm_fixtures import LOWER, clashing, documents, frame

from lotmarket.llm.merkle_manifest import folded, manifest
from lotmarket.llm.merkle_query import FIELDS, checked


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(i, text, lang, source, n):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)])


def tree(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([digest(*x[k:k + fanout]) for k in range(0, len(x), fanout)])
    return levels


def path(levels, k, fanout):
    steps = []
    for x in levels[:-1]:
        lo = k // fanout * fanout
        steps.append(("".join(x[lo:k]), "".join(x[k + 1:lo + fanout])))
        k //= fanout
    return steps


def brute(rows, fanout=16):
    by = defaultdict(list)
    for row in rows:
        by[row[3]].append(row)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        trees[s] = tree([leaf_of(*r) for r in by[s]], fanout)
    top = tree([trees[s][-1][0] for s in order], fanout)
    out = []
    for at, s in enumerate(order):
        for k, r in enumerate(by[s]):
            steps = path(trees[s], k, fanout) + path(top, at, fanout)
            node = leaf_of(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                node = leaf_of(r[0], r[1] and r[1].translate(LOWER), *r[2:])
            for left, right in steps:
                node = digest(left, node, right)
            root = top[-1][0]
            out.append((r[0], leaf_of(*r), trees[s][-1][0], root, digest(*[a + b for a, b in steps]), node, node == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def odd_rows():
    rows = [(i, t, lang if i and i % 7 else None, [None, "", "é", "a", "Z"][(i or 0) % 5], n) for i, t, lang, _, n in documents()]
    return rows + [(3000 + i, f"Text {i}", "en", "hot", i) for i in range(90)] + [(4000 + i, "A", None, f"s{i}", 1) for i in range(21)]


@pytest.mark.parametrize("fanout,levels", [(16, 3), (16, 1), (2, 1), (3, 2), (4, 0)])
def test_against_brute_force(spark, fanout, levels):
    rows = odd_rows()
    assert got(checked(clashing(frame(spark, rows)), fanout=fanout, block_levels=levels)) == brute(rows, fanout)


def test_small_and_empty_tables(spark):
    assert checked(frame(spark, [])).collect() == []
    for rows in ([(1, "A", None, None, None)], [(1, None, "en", "x", 1), (2, None, "en", "x", 1)], [(i, None, None, None, None) for i in range(20)],
                 [(5, "a", "en", f"s{i:02}", 2) for i in range(17)]):
        assert got(checked(frame(spark, rows), block_levels=1)) == brute(rows)


def test_proofs_are_real(spark):
    rows = manifest(frame(spark, odd_rows()), FIELDS, block_levels=1)
    from pyspark.sql import functions as F
    assert rows.where(folded(F.col("leaf"), F.col("proof")) != F.col("root")).isEmpty()
    assert rows.where(folded(F.sha2("leaf", 256), F.col("proof")) == F.col("root")).isEmpty()
