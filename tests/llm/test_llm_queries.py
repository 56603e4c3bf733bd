"""Registered queries against their SQL, and the pipeline against brute force of its stages."""

import duckdb
import pytest
from llm_fixtures import SPACE  # noqa: F401

import corpus_pipeline
from lotmarket.llm import decontaminate, jaccard_join, registry
from lotmarket.plans.binding import TABLES

SF = "/root/testdata/sf0.001"
MORE = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in {*TABLES, *MORE}:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in registry.queries()) == list(range(1, 14))


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_query(spark, con, key):
    frame = registry.queries()[key](spark, SF)
    cols = sorted(frame.columns)
    got = sorted((tuple(r[c] for c in cols) for r in frame.collect()), key=str)
    assert got
    if sql := registry.oracle_sql().get(key):
        res = con.execute(sql)
        names = [d[0] for d in res.description]
        assert sorted(names) == cols
        assert got == sorted((tuple(r[names.index(c)] for c in cols) for r in res.fetchall()), key=str)


def test_pipeline(spark):
    docs = corpus_pipeline.table(spark, SF, "documents")
    columns, kept = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(corpus_pipeline.written(stage(spark, kept[-1], SF), "test-stage"))
    assert len(kept) == 6 and all(k.columns == columns for k in kept[:-1])
    _, good, lines, alone, clean, pieces = kept
    assert good.count() == lines.count() > alone.count() > clean.count() == pieces.count() > 0
    links = jaccard_join.link(alone)
    assert links.where("doc_id <> component_id").isEmpty()
    assert decontaminate.matches(clean, corpus_pipeline.table(spark, SF, "benchmark")).isEmpty()
    assert pieces.where("NOT round_trip").isEmpty()
    assert corpus_pipeline.run(spark, SF).count() == pieces.count()
