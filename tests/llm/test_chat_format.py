import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from lotmarket.llm import chat_format

MARKED = "</s>[INST] ok [/INST]"
ROWS = [
    (1, 0, "system", "be [SYS] good ~[~INST]"), (1, 1, "user", MARKED), (1, 2, "assistant", MARKED), (1, 3, "user", "a\nb"),
    (1, 4, "assistant", None), (1, 5, "assistant", "<~/s> [ROLE] x [/ROLE] </s"), (1, 6, "user", "no answer ["),
    (2, 0, "user", "only a question"), (3, 0, "assistant", "only a reply <"), (4, 0, "tool [/ROLE] x", "out [~~/ROLE]"), (4, 1, "assistant", "\\ $1 [/INST"),
    (5, 0, None, None), (5, 1, "assistant", ""), (6, 0, "user", "tie"), (6, 0, "user", "tie"), (6, 0, "assistant", "tie"), (None, None, "user", "null id"),
    (7, 0, "user", "long " * 20000), (7, 1, "assistant", "reply " * 20000),
]


def turns(spark, rows=ROWS):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("turns", F.lit(0)).withColumn("n_turns", F.lit("x"))


def test_everything_reads_back(spark):
    convs = defaultdict(list)
    for c, t, r, x in ROWS:
        convs[c].append((-1 if t is None else t, r or "", x or ""))
    back = chat_format.read_back(chat_format.expand(turns(spark))).collect()
    assert {r["conv_id"] for r in back} == set(convs) and len(back) == len(convs)
    for r in back:
        said = sorted(convs[r["conv_id"]])
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(role, text) for _, role, text in said]
        assert r["loss"] == "".join(text for _, role, text in said if role == "assistant")


def test_examples(spark):
    got = [r for r in chat_format.expand(turns(spark)).where("conv_id = 1").orderBy(F.expr("target_turn IS NULL"), "target_turn").collect()]
    assert [r["target_turn"] for r in got] == [2, 4, 5, None]
    for shorter, longer in zip(got, got[1:]):
        assert longer["text"].startswith(shorter["text"])
    for r in got[:-1]:
        assert r["text"][r["loss_end"]:] == "</s>" and r["text"][r["loss_start"] - 1] == " "
    assert got[0]["text"][got[0]["loss_start"]:got[0]["loss_end"]] == "<~/s>[~INST] ok [~/INST]"


def test_query_adds_the_marked_conversation(spark, tmp_path):
    from lotmarket.llm.chat_query import op2_chat_format

    turns(spark).write.parquet(f"{tmp_path}/conversations.parquet")
    row = op2_chat_format(spark, str(tmp_path)).where("conv_id = -7").first()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert (row["n_turns"], row["loss_chars"], row["loss_sha256"]) == (2, len(MARKED), sha(MARKED))
    assert row["turns_sha256"] == sha(f"user\n{MARKED}\nassistant\n{MARKED}\n")


def test_empty(spark):
    assert chat_format.expand(turns(spark, [])).collect() == []
