"""Exact dedup by content-defined chunk recipes, in built-in functions only.

1. A text, A-Z lower-cased, is cut into *chunks*: a chunk ends at the first sentence or line end after ``MIN_CHARS``
   characters, at the latest after ``MAX_CHARS``.  Where it ends depends on what it holds and not on its place.
2. Chunks are deduplicated to *identifiers* of 128 bits: distinct (identifier, chunk) pairs are made map-side first, so
   each text moves once at most, and an identifier with two different chunks refutes the numbering, which is then made
   anew with another seed.  What goes on is verified against the chunks' own bytes.
3. A document is now its *recipe*, the ordered list of its identifiers; two texts are equal when their lists are.  From
   here on only lists move.  Lists are counted per list, with map-side combining, and the result returns to the rows:
   lists of ``rows / HOT_LISTS`` copies or more, of which there are ``HOT_LISTS`` at most, by broadcast, so a list that
   a third of all rows share is not dealt to one task; all others by an ordinary join.

Nulls and edge cases: a null text is empty, and empty texts are equal to each other (an empty list).  The row with the
largest id stays; a null id is smaller than any, and among rows of one id (repeated rows) exactly one stays.  An empty
table gives an empty result.  Columns that are carried stay as they are, but one with the name of a result column is
replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotmarket.llm.common import ascii_lower, written

MIN_CHARS = 256
MAX_CHARS = 2048
#: Most lists that are broadcast; each stands for a share of one in HOT_LISTS rows or more.
HOT_LISTS = 10_000
RESULT = ("keep_id", "group_size", "kept", "text_sha256")
_OWN = "__recipe_"


def normalised(text: Column) -> Column:
    """Null as empty, A-Z lower-cased; a text of ASCII alone takes the faster general function."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(ascii_lower(t))


def chunks(text: Column, min_chars: int = MIN_CHARS, max_chars: int = MAX_CHARS) -> Column:
    """The chunks of a text in order; joined they are the text.  An empty text has none."""
    end = r"(?:\n|[.!?;:。！？]\s)"
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{{min_chars},{max_chars - 2}}}?{end}|.{{1,{max_chars}}}"), F.lit(0))


def identifier(chunk: Column, seed: int) -> Column:
    """128 bits of a chunk."""
    return F.struct(F.xxhash64(F.lit(2 * seed), chunk).alias("a"), F.xxhash64(F.lit(2 * seed + 1), chunk).alias("b"))


def chunk_store(docs: DataFrame, text: str = "text", seed: int = 0) -> DataFrame:
    """(id, chunk): the distinct chunks of all texts; recipes and store together give the normalised texts back."""
    each = docs.select(F.explode(chunks(normalised(F.col(text)))).alias("chunk"))
    return each.select(identifier(F.col("chunk"), seed).alias("id"), "chunk").distinct()


def verified(store: DataFrame) -> bool:
    """Whether no identifier stands for two chunks."""
    return store.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def verified_seed(docs: DataFrame, text: str = "text") -> int:
    """The first seed whose identifiers are verified on these texts."""
    return next(s for s in count() if verified(chunk_store(docs, text, s)))


def recipes(docs: DataFrame, text: str = "text", seed: int = 0) -> DataFrame:
    """``docs`` with ``recipe`` (identifiers in order) and ``text_sha256`` (of the normalised text)."""
    cut = docs.withColumn("text_sha256", F.sha2(normalised(F.col(text)), 256))
    return cut.withColumn("recipe", F.transform(chunks(normalised(F.col(text))), lambda c: identifier(c, seed)))


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: Sequence[str] | None = None) -> DataFrame:
    """A row for each row of ``docs``: the columns ``carry`` (all unless given), ``keep_id`` (id of the row of equal text
    that stays), ``group_size``, ``kept`` and ``text_sha256``."""
    carry = [c for c in (docs.columns if carry is None else carry) if c not in RESULT]
    named = docs.select(F.col(doc_id).alias(_OWN + "id"), F.col(text).alias(_OWN + "text"), F.struct(F.lit(0), *carry).alias(_OWN + "carry"))
    own = recipes(named, _OWN + "text", verified_seed(docs, text)).select(
        F.col(_OWN + "carry").alias("carry"), F.col(_OWN + "id").alias("id"), "text_sha256", "recipe")
    # The number of a row is fixed once the table is written.
    rows = written(own.withColumn("row", F.monotonically_increasing_id()), "recipes")
    lists = written(rows.groupBy("recipe").agg(
        F.count(F.lit(1)).alias("group_size"), F.max("id").alias("keep_id"),
        F.coalesce(F.max_by("row", "id"), F.max("row")).alias("keep_row")).where("group_size > 1"), "recipe-groups")
    hot = F.col("group_size") >= max(2, -(-rows.count() // HOT_LISTS))
    met = rows.join(F.broadcast(lists.where(hot)), "recipe")
    rest = rows.join(F.broadcast(lists.where(hot)), "recipe", "left_anti").join(lists.where(~hot), "recipe", "left")
    out = met.unionByName(rest)
    alone = F.col("group_size").isNull()
    return out.select(
        *[F.col("carry").getField(c).alias(c) for c in carry],
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), "text_sha256")


def without_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    whole = docs.select(F.struct(*docs.columns).alias(_OWN + "row"), F.col(text).alias(_OWN + "text"), F.col(doc_id).alias(_OWN + "id"))
    return exact_groups(whole, _OWN + "text", _OWN + "id", [_OWN + "row"]).where("kept").select(_OWN + "row.*")
