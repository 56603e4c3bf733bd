from collections import defaultdict
from hashlib import sha256

from llm_fixtures import LOWER, clashing, documents, frame, prose
from pyspark.sql import functions as F

from lotmarket.llm import chunk_recipes as R


def brute(rows):
    held = defaultdict(list)
    for i, text, *_ in rows:
        held[(text or "").translate(LOWER)].append(-1 if i is None else i)
    out = []
    for t, ids in held.items():
        keep = max(ids)
        for k, i in enumerate(sorted(ids)):
            out.append((i, keep, len(ids), k == len(ids) - 1, sha256(t.encode()).hexdigest()))
    return sorted(out)


def rows_of(df):
    low = lambda x: -1 if x is None else x
    return sorted((low(r["doc_id"]), low(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect())


def case_rows():
    import random
    rng = random.Random(5)
    long = ". ".join(prose(rng, 200) for _ in range(60))
    rows = [(1000 + i, t, None, None, None) for i, t in enumerate(
        ["ABC", "abc", "Abc", "É", "é", "Éa", "ÉA", long, long.upper(), long[:-1], long[:-1] + "!", "x" * 9000, "X" * 9000, "x" * 8999])]
    return documents() + rows


def test_against_brute_force(spark):
    rows = case_rows()
    got = rows_of(R.exact_groups(clashing(frame(spark, rows))))
    assert got == brute(rows) and max(r[2] for r in got) > 3


def test_lists_beyond_the_broadcast_meet_by_an_ordinary_join(spark, monkeypatch):
    monkeypatch.setattr(R, "HOT_LISTS", 20)
    rows = case_rows() + [(5000 + i, "the same words", None, None, None) for i in range(90)]
    assert rows_of(R.exact_groups(frame(spark, rows))) == brute(rows)


def test_refuted_identifiers_are_made_anew(spark, monkeypatch):
    whole = R.identifier
    weak = lambda c, seed: F.struct(F.pmod(F.xxhash64(c), F.lit(3)).alias("a"), F.lit(0).cast("long").alias("b")) if seed == 0 else whole(c, seed)
    monkeypatch.setattr(R, "identifier", weak)
    df = frame(spark, case_rows())
    assert not R.verified(R.chunk_store(df)) and R.verified_seed(df) == 1
    assert rows_of(R.exact_groups(df)) == brute(case_rows())


def test_recipes_and_store_give_the_texts_back(spark):
    df = frame(spark, case_rows()).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    parts = R.recipes(df).select("doc_id", F.posexplode("recipe").alias("place", "id")).join(R.chunk_store(df), "id")
    back = {r[0]: "".join(x["chunk"] for x in r[1]) for r in parts.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("place", "chunk")))).collect()}
    for i, text in df.select("doc_id", "text").collect():
        assert back.get(i, "") == (text or "").translate(LOWER)


def test_an_edit_moves_few_chunks(spark):
    import random
    rng = random.Random(9)
    sentences = [prose(rng, 12) + "." for _ in range(400)]
    a = " ".join(sentences)
    df = spark.createDataFrame([(1, a), (2, "An insertion. " + a)], "doc_id long, text string")
    one, two = (set(map(tuple, r["recipe"])) for r in R.recipes(df).orderBy("doc_id").collect())
    assert len(one) > 40 and len(one & two) > 0.7 * len(one)


def test_rows_that_stay(spark):
    df = clashing(frame(spark, case_rows()))
    kept = R.without_copies(df)
    assert kept.columns == df.columns
    assert kept.count() == len({(t or "").translate(LOWER) for _, t, *_ in case_rows()})
    assert kept.where("kept <> 'other'").isEmpty()


def test_empty_and_null_tables(spark):
    assert R.exact_groups(frame(spark, [])).collect() == []
    got = rows_of(R.exact_groups(frame(spark, [(i, None, None, None, None) for i in range(5)])))
    assert [r[1:4] for r in got] == [(4, 5, False)] * 4 + [(4, 5, True)]


def test_no_python_in_the_plan(spark):
    from lotmarket.llm.recipe_query import op11_exact_dedup
    plan = op11_exact_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
