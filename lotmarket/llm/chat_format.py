"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only that reply is under the
loss mask.  An example's ``text`` is the conversation up to and with the reply in the template below; ``loss_start``
and ``loss_end`` are the code points of the reply inside it.  A conversation that doesn't end with an assistant turn
has one more row, ``target_turn`` null and the mask empty, so that the output holds every turn.

Template (fixed marks): ``<s>`` once, then by role ``[SYS] text [/SYS]``, ``[INST] text [/INST]``,
``" " text </s>`` for the assistant, and ``[ROLE] role [/ROLE] text</s>`` for any other role.  A mark inside a text is
escaped by one ``~`` after its bracket (``[~INST]``; one more if there are some already), so that reading back is
exact: ``parse_turns`` undoes it all with built-in functions.

Everything is built-in Spark functions; conversations shuffle once, by id.  By its definition the expanded text grows
with the square of a conversation's turns, and a conversation's turns meet in one row, since its digest is sequential.

Nulls and edge cases: a null text or role is an empty one; a null id is an id; turns are ordered by (turn, role, text),
so ties and repeated rows stay, in a fixed order; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A mark, with what it has between its bracket and its name.
_MARK = r"(~*)(/?(?:INST\]|SYS\]|ROLE\])|/?s>)"
_FIND = r"([\[<])" + _MARK
_STUFFED = r"([\[<])~" + _MARK
#: One formatted turn.
_TURN = (r"(?s)\[SYS\] .*? \[/SYS\]|\[INST\] .*? \[/INST\]|\[ROLE\] .*?</s>| .*?</s>")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _FIND, "$1~$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _STUFFED, "$1$2$3")


def _segment(turn: Column) -> Column:
    role, text = turn["role"], escape(turn["text"])
    return (F.when(role == "system", F.concat(F.lit("[SYS] "), text, F.lit(" [/SYS]")))
            .when(role == "user", F.concat(F.lit("[INST] "), text, F.lit(" [/INST]")))
            .when(role == "assistant", F.concat(F.lit(" "), text, F.lit("</s>")))
            .otherwise(F.concat(F.lit("[ROLE] "), escape(role), F.lit(" [/ROLE] "), text, F.lit("</s>"))))


def expand(turns: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """Examples (conv_id, n_turns, target_turn, text, loss_start, loss_end), one for each assistant turn and tail."""
    empty = F.lit("")
    convs = turns.groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_list(F.struct(
        F.col("turn"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")))).alias("turns"))
    convs = convs.withColumn("segments", F.transform("turns", _segment)).withColumn("n_turns", F.size("turns").cast("long"))
    convs = convs.withColumn("targets", F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (F.get("turns", i)["role"] == "assistant") | (i == F.size("turns") - 1)))
    at = convs.withColumn("at", F.explode("targets"))
    at = at.withColumn("text", F.concat(F.lit("<s>"), F.array_join(F.slice("segments", F.lit(1), F.col("at") + 1), "")))
    trained = F.get("turns", F.col("at"))["role"] == "assistant"
    reply_end = F.length("text") - len("</s>")
    reply_start = F.length("text") - F.length(F.get("segments", F.col("at"))) + 1
    return at.select("conv_id", "n_turns", F.when(trained, F.col("at")).cast("long").alias("target_turn"), "text",
                     F.when(trained, reply_start).otherwise(0).cast("long").alias("loss_start"),
                     F.when(trained, reply_end).otherwise(0).cast("long").alias("loss_end"))


def parse_turns(text: Column) -> Column:
    """The array of (role, text) that a formatted text was made from."""

    def one(seg: Column) -> Column:
        cut = lambda a, b: unescape(F.substring(seg, F.lit(a + 1), F.length(seg) - (a + b)))
        other = F.regexp_extract(seg, r"(?s)^\[ROLE\] (.*?) \[/ROLE\] (.*)</s>$", 1)
        other_text = F.regexp_extract(seg, r"(?s)^\[ROLE\] (.*?) \[/ROLE\] (.*)</s>$", 2)
        pair = lambda role, body: F.struct(role.alias("role"), body.alias("text"))
        return (F.when(seg.startswith("[SYS] "), pair(F.lit("system"), cut(6, 7)))
                .when(seg.startswith("[INST] "), pair(F.lit("user"), cut(7, 8)))
                .when(seg.startswith("[ROLE] "), pair(unescape(other), unescape(other_text)))
                .otherwise(pair(F.lit("assistant"), cut(1, 4))))

    return F.transform(F.regexp_extract_all(F.substring(text, 4, 1 << 30), F.lit(_TURN), F.lit(0)), one)


def loss_text(text: Column, start: Column, end: Column) -> Column:
    """What is under the loss mask, unescaped."""
    return unescape(F.substring(text, start.cast("int") + 1, (end - start).cast("int")))


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the examples alone: all turns (role, text), all text under the mask, and total length."""
    x = examples.withColumn("reply", F.when(F.col("target_turn").isNotNull(),
                                            loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end"))))
    longest = F.struct(F.length("text").alias("n"), F.col("text"))
    convs = x.groupBy("conv_id").agg(
        F.max(longest)["text"].alias("longest"), F.sum(F.length("text")).cast("long").alias("formatted_chars"),
        F.count("target_turn").alias("n_examples"),
        F.sort_array(F.collect_list(F.when(F.col("target_turn").isNotNull(), F.struct("target_turn", "reply")))).alias("replies"))
    return (convs.withColumn("turns", parse_turns(F.col("longest")))
            .withColumn("loss", F.array_join(F.transform("replies", lambda r: r["reply"]), "")).drop("longest", "replies"))
