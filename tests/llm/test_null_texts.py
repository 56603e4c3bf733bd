"""Tables whose every text is null: each operator gives its defined result."""

import public_tokenizers
import pytest
from llm_fixtures import clashing, frame

from lotmarket.llm import decontaminate, jaccard_join, language_id, line_dedup, piece_transducer, quality_rules, suffix_dedup, token_count

ROWS = [(i, None, "en" if i % 2 else None, "s", None) for i in range(6)] + [(3, None, "en", "s", None)]
IDS = sorted(r[0] for r in ROWS)


@pytest.fixture
def docs(spark):
    return clashing(frame(spark, ROWS))


def test_links(docs):
    got = sorted(tuple(r) for r in jaccard_join.link(docs).select("doc_id", "n_shingles", "component_id").collect())
    assert got == [(i, 0, i) for i in IDS]


def test_matches_and_without(spark, docs):
    items = spark.createDataFrame([(1, None), (2, "one two three four five six")], "item_id bigint, text string")
    found = decontaminate.matches(docs, items)
    assert found.collect() == []
    assert decontaminate.without(docs, found, unnamed=True).count() == len(ROWS)


def test_tokens_and_pieces(spark):
    docs = frame(spark, ROWS).select("doc_id", "text")
    tokens = token_count.counted(docs, public_tokenizers.path("word_bpe_49k.json"), carry=["doc_id"]).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens) == [(i, 0, 0, False) for i in IDS]
    assert piece_transducer.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), carry=["doc_id"]).count() == len(ROWS)


def test_lines(docs):
    got = line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(tuple, got)) == [(i, 1, 0, "") for i in IDS]


def test_languages(spark):
    docs = frame(spark, ROWS)
    got = language_id.predict(docs, language_id.fit(docs), carry=["doc_id"]).collect()
    assert sorted((r.doc_id, r.lang_pred) for r in got) == [(i, "und") for i in IDS]


def test_quality(docs):
    got = quality_rules.judge(docs).select("doc_id", "n_words", "base_failed", "kept").collect()
    assert sorted(map(tuple, got)) == [(i, 0, True, False) for i in IDS]


def test_repeats(spark):
    got = suffix_dedup.without_repeats(frame(spark, ROWS), carry=["doc_id"]).select("doc_id", "n_removed", "n_spans").collect()
    assert sorted(map(tuple, got)) == [(i, 0, 0) for i in IDS]
