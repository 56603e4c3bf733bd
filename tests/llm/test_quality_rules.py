from collections import Counter

from llm_fixtures import clashing, documents, frame, words
from pyspark.sql import functions as F

from lotmarket.llm import quality_rules


def brute(text):
    text = text or ""
    w = words(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    times, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if words(x)]
    n = len(w)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_base_counts(spark):
    rows = quality_rules.judge(clashing(frame(spark))).collect()
    assert len(rows) == len(documents())
    for r in rows:
        assert tuple(r[c] for c in quality_rules.BASE_COLUMNS) == brute(r["text"])
        assert not (r["kept"] and r["base_failed"])


def test_filter_on_the_verdict_gives_the_same_rows(spark):
    judged = quality_rules.judge(frame(spark))
    expected = sorted(str(r["text"]) for r in judged.collect() if r["kept"])
    assert sorted(str(r["text"]) for r in judged.where("kept").select("text").collect()) == expected and expected


def test_rules(spark):
    good = "the house of the man and the dog is in the town that was by the sea " * 3 + "for it was on a hill"
    cases = {"symbols": good.replace(" ", "### "), "shouting": good.upper(), "no_letters": " | ".join(good.split()),
             "exclamations": good.replace(" ", "! "), "stop_words": " ".join(f"zq{i}x" for i in range(60)), "": " ".join(f"{w}{i}" if w not in ("the", "of") else w for i, w in enumerate(good.split()))}
    rows = [(i, t, None, None, None) for i, t in enumerate(cases.values())]
    got = {r["doc_id"]: r["broken_rules"].split(",") for r in quality_rules.judge(frame(spark, rows)).collect()}
    for i, name in enumerate(cases):
        assert name in got[i] if name else got[i] == [""]


def test_empty(spark):
    assert quality_rules.judge(frame(spark, [])).collect() == []


def test_columns_named_like_working_columns_stay(spark):
    plain = sorted(tuple(map(str, r)) for r in quality_rules.judge(frame(spark)).collect())
    odd = frame(spark).select("*", *[F.lit(c).alias(c) for c in ("_words", "_Lines", "_hashes", "_sorted", "_places", "_given_words")])
    out = quality_rules.judge(odd)
    given = odd.columns[5:]
    assert out.columns[:len(odd.columns)] == odd.columns
    assert {tuple(r) for r in out.select(*given).collect()} == {tuple(given)}
    assert sorted(tuple(map(str, r)) for r in out.drop(*given).collect()) == plain
    moved = quality_rules.judge(frame(spark).withColumnRenamed("text", "_words"), text="_words")
    assert sorted(tuple(map(str, r)) for r in moved.collect()) == plain


def test_texts_all_null(spark):
    rows = [(i, None, None, None, None) for i in range(5)]
    assert {(r["n_words"], r["base_failed"], r["kept"], r["broken_rules"]) for r in quality_rules.judge(frame(spark, rows)).collect()} == {(0, True, False, "")}
