"""Quality rules: a threshold table compiled into one Spark projection.

``metrics`` names a ratio or count per document, ``RULES`` bounds it from below and above, and ``compile_rules`` turns
the table into one array expression of the names of the rules that a row breaks.  All of it is built-in functions: no
user function, no shuffle, no join; each document is judged alone, by its whole text.

Null and empty texts have no words: every count is 0, ratios are null and break no rule, and the row fails the base
rule of ten words.  Repeated rows are judged alike.  Columns of the input are kept; where one has the name of a result
column, the result replaces it.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotmarket.llm.common import SPACE_CHARS, SPACE_CLASS, unused, words_of


class Rule(NamedTuple):
    """A document breaks the rule if its metric is below ``low`` or above ``high``; None leaves that side open."""

    name: str
    metric: str
    low: float | None
    high: float | None


RULES = (
    Rule("word_length", "mean_word_chars", 2.5, 12.0),
    Rule("symbols", "symbol_ratio", None, 0.2),
    Rule("no_letters", "letterless_ratio", None, 0.3),
    Rule("stop_words", "stop_ratio", 0.01, None),  # from MIN_STOP_WORDS words on: a short text may have none
    Rule("shouting", "upper_ratio", None, 0.4),
    Rule("exclamations", "bang_ratio", None, 0.2),
    Rule("repeated_lines", "dup_line_ratio", None, 0.5),
    Rule("bullets", "bullet_line_ratio", None, 0.9),
    Rule("ellipses", "ellipsis_line_ratio", None, 0.5),
)

#: Frequent function words of the languages in the corpus.
STOP_WORDS = {
    "en": "the and of to a in is that it was for on with this as be are by from at",
    "fr": "et la de le des les en un du pour est une que qui par au sur dans pas il",
    "de": "der und die in von den sich zu das mit auf nicht für des ein im ist dem eine als",
    "es": "de la que el en los y se del un para no con las su una es por al lo",
}

MIN_WORDS = 10
MIN_STOP_WORDS = 30
REPEAT_PERCENT = 20
WINDOW = 5
WORKING = ("_words", "_lines", "_hashes", "_sorted", "_places")
BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _repeated_places(pairs: Column) -> Column:
    """Sorted places of the windows that come twice or more, from the windows' (hash, place) pairs in order."""
    twice = F.filter(pairs, lambda s, j: (
        F.coalesce(F.get(pairs, j + 1)["h"] == s["h"], F.lit(False))
        | F.coalesce(F.get(pairs, j - 1)["h"] == s["h"], F.lit(False))))
    return F.sort_array(F.transform(twice, lambda s: s["i"]))


def _covered(places: Column) -> Column:
    """Words that the windows at these places cover, each once."""
    steps = F.transform(places, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the base counts, and working columns that begin with an underscore."""
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.withColumn("_words", words_of(F.col(text)))
    d = d.withColumn("_lines", F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != ""))
    w = F.col("_words")
    d = d.withColumn("n_words", F.size(w).cast("long"))
    d = d.withColumn("_hashes", F.when(F.col("n_words") >= WINDOW, F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WINDOW)]))).otherwise(F.array().cast("array<bigint>")))
    d = d.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
        F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    d = d.withColumn("word_chars", F.length(F.array_join(w, "")).cast("long"))
    d = d.withColumn("n_symbols", F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long"))
    d = d.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    # A column of its own for each step: an expression used inside a lambda would be worked out again for each element.
    d = d.withColumn("_places", _repeated_places(F.col("_sorted")))
    d = d.withColumn("n_repeat_words", F.coalesce(_covered(F.col("_places")), F.lit(0).cast("long")))
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def metrics(text: str = "text") -> dict[str, Column]:
    """The named ratios, over the columns that ``measure`` adds; a ratio without a denominator is null."""
    t = F.coalesce(F.col(text), F.lit(""))
    n, lines = F.col("n_words"), F.size("_lines")
    over = lambda a, b: F.when(b > 0, a / b)
    stop = sorted({w for ws in STOP_WORDS.values() for w in ws.split()})
    letterless = F.size(F.regexp_extract_all(
        t, F.lit(rf"(?<![^{SPACE_CLASS}])[^\p{{L}}{SPACE_CLASS}]+(?![^{SPACE_CLASS}])"), F.lit(0)))
    return {
        "mean_word_chars": over(F.col("word_chars"), n),
        "symbol_ratio": over(F.col("n_symbols"), n),
        "letterless_ratio": over(letterless, n),
        "stop_ratio": F.when(n >= MIN_STOP_WORDS, F.size(F.filter("_words", lambda w: F.lower(w).isin(stop))) / n),
        "upper_ratio": over(F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")), F.col("word_chars")),
        "bang_ratio": over(F.size(F.regexp_extract_all(t, F.lit(r"!+"), F.lit(0))), n),
        "dup_line_ratio": over(F.col("n_dup_lines"), lines),
        "bullet_line_ratio": over(F.size(F.filter("_lines", lambda x: x.rlike(r"^[\x20\x09]*[-*•]"))), lines),
        "ellipsis_line_ratio": over(F.size(F.filter("_lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))), lines),
    }


def compile_rules(rules: tuple[Rule, ...] = RULES, text: str = "text") -> Column:
    """One expression: the names of the broken rules, in the table's order."""
    have = metrics(text)
    checks = []
    for r in rules:
        m = have[r.metric]
        broken = F.lit(False)
        if r.low is not None:
            broken = broken | (m < r.low)
        if r.high is not None:
            broken = broken | (m > r.high)
        checks.append(F.when(F.coalesce(broken, F.lit(False)), F.lit(r.name)))
    return F.array_compact(F.array(*checks))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``broken_rules`` (names, comma-joined) and ``kept``."""
    # Input columns named like working columns step aside meanwhile.
    aside: dict[str, str] = {}
    for c in docs.columns:
        if c.lower() in WORKING:
            aside[c] = unused(f"_given{c}", [*docs.columns, *aside.values()])
    text = aside.get(text, text)
    d = measure(docs.withColumnsRenamed(aside), text)
    d = d.withColumn("broken_rules", F.array_join(compile_rules(rules, text), ","))
    # A filter on the result must not move below these projections, as it would take their expressions along and put
    # them into each other's lambdas; Spark leaves it where it is if a column here isn't deterministic.
    always = F.spark_partition_id() >= 0
    d = d.withColumn("kept", ~F.col("base_failed") & (F.col("broken_rules") == "") & always)
    return d.drop(*WORKING).withColumnsRenamed({new: c for c, new in aside.items()})
