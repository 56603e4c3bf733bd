import zlib

from llm_fixtures import clashing, documents, frame
from pyspark.sql import functions as F

from lotmarket.llm import language_id


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("out", language_id.held_out(F.col("doc_id")))
    model = language_id.fit(docs.where("NOT out").select("text", "lang"))
    got = language_id.predict(docs, model).where("out").collect()
    assert len(got) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert (model.weights == 0).mean() > 0.5 and model.temperature > 0
    odd = {r["doc_id"]: r for r in language_id.predict(clashing(frame(spark, documents() + [(900, "12 ...", *[None] * 3)])), model).collect()}
    assert (odd[0]["lang_pred"], odd[0]["score"], odd[900]["lang_pred"]) == ("und", 0.0, "und")


def test_held_out_rule(spark):
    got = spark.range(50).select("id", language_id.held_out(F.col("id")).alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in got)


def test_nothing_to_learn_from(spark):
    assert language_id.fit(frame(spark, []).select("text", "lang")) is None
    got = language_id.predict(frame(spark), None).collect()
    assert len(got) == len(documents()) and {r["lang_pred"] for r in got} == {"und"}


def test_one_language(spark):
    model = language_id.fit(frame(spark).select("text", "lang"))
    assert {r["lang_pred"] for r in language_id.predict(frame(spark), model).collect()} == {"en", "und"}
    assert language_id.predict(frame(spark, []), model).collect() == []


def test_rare_languages_are_all_trained_on(spark):
    rows = [(f"{chr(0x4E00 + 40 * k)}{chr(0x4E01 + 40 * k)}", f"l{k}") for k in range(40)]  # one row each
    model = language_id.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == sorted(x for _, x in rows)
    assert (model.weights > 0).any(axis=0).all()  # only a language's own rows raise a weight
