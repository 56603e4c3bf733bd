from collections import defaultdict

import pytest
from llm_fixtures import LOWER, clashing, documents, frame

from lotmarket.llm.line_dedup import dedup_lines


def brute(rows, min_chars, min_docs):
    held = defaultdict(set)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    for i, text, *_ in rows:
        if i is not None:
            for line in (text or "").split("\n"):
                held[key(line)].add(i)
    heavy = {k: max(v) for k, v in held.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or heavy.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches,fanout,min_docs", [(1, 2, 5), (4, 2, 5), (5, 3, 2)])
def test_against_brute_force(spark, batches, fanout, min_docs):
    out = dedup_lines(clashing(frame(spark)), 40, min_docs, batches, fanout).collect()
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in out), key=str)
    expected = brute(documents(), 40, min_docs)
    assert got == expected and any(x[2] for x in expected)


def test_empty(spark):
    assert dedup_lines(frame(spark, [])).collect() == []


def test_no_run_stays_in_the_catalog(spark):
    before = {t.name for t in spark.catalog.listTables()}
    out = dedup_lines(frame(spark))
    assert {t.name for t in spark.catalog.listTables()} == before
    assert out.count() == len(documents())


def test_texts_all_null(spark):
    rows = [(i, None, None, None, None) for i in range(8)]
    assert {(r["n_lines"], r["n_dropped"], r["kept_text"]) for r in dedup_lines(frame(spark, rows)).collect()} == {(1, 0, "")}
