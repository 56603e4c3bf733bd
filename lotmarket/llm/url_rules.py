"""URL filters: association rules mined by FP-growth, matched through an inverted index.

Features of a URL are all its host's labels (``h:``; the last two together as ``d:``), the distinct words of its path
(``p:``; a number is ``#``) and the names of its query keys (``q:``), wherever they stand.

``mine`` bounds FP-growth's work without loss: features of too little support go, and features that the same labelled
rows have (a site's labels, a deep path that many pages share) are one item.  It runs Spark's FP-growth over these items
together with the label, and keeps rules ``features -> bad`` of enough support and confidence; a rule that a part of its
items already makes with no less confidence is pruned.  Rules stay rules over items: a URL holds an item if it has any
of its features, as if every choice of one feature for each item were a rule.  All labelled rows are mined.

``match`` works on distinct signatures: a URL's signature is what it has of the features of items that rules name.  Each
rule is posted under its rarest item; signatures meet the posting lists by an equi-join on their items and keep the rules
of which they hold every item.  The verdict returns to the rows by the signature.

Explicit rules (allow or block; a host with its subdomains, and a path prefix) come first: the longest that fits
decides.  They are arguments and become one CASE expression.

Nulls and edge cases: a null URL, or one without ``://``, has empty host and path, fits no rule and has no features,
so it is allowed; repeated rows stay; without labels of both kinds nothing is mined and everything is allowed; other
columns of the input are kept unless they have a result column's name.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotmarket.llm.common import ascii_lower, unused, written

BAD, GOOD = "label:bad", "label:good"


class HostRule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty where there is none."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def explicit(rules: tuple[HostRule, ...], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def features(url: Column, host: Column, path: Column) -> Column:
    """The sorted distinct features of a URL."""
    tag = lambda t, xs: F.transform(xs, lambda x: F.concat(F.lit(t + ":"), x))
    filled = lambda xs: F.filter(xs, lambda x: x != "")
    labels = F.reverse(filled(F.split(host, r"\.")))
    domain = F.array_join(F.reverse(F.slice(labels, 1, 2)), ".")
    segments = F.transform(filled(F.split(path, "[/._-]+")), lambda x: F.regexp_replace(ascii_lower(x), "[0-9]+", "#"))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(filled(F.split(query, "&")), lambda x: F.substring_index(x, "=", 1))
    return F.array_sort(F.array_distinct(F.concat(
        tag("h", labels), tag("d", F.array(domain)), tag("p", segments), tag("q", keys))))


def mine(labelled: DataFrame, min_support: float = 0.002, min_rows: int = 10, min_confidence: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """Rules (antecedent, n_items, confidence, support) over items from rows (features, bad), and the items (feature, item)."""
    rows = written(labelled.where(F.col("bad").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), "features", F.when(F.col("bad"), BAD).otherwise(GOOD).alias("label")), "url-labelled")
    n = rows.count()
    least = max(1, math.ceil(min(1.0, max(min_support, min_rows / max(n, 1))) * n - 1e-6))
    groups = _groups(rows, least)
    each = rows.select("row", F.explode("features").alias("feature"))
    grouped = each.join(groups.where("feature = item"), "feature").groupBy("row").agg(F.collect_set("item").alias("some"))
    baskets = written(rows.join(grouped, "row", "left").select(F.array_append(
        F.coalesce("some", F.array().cast("array<string>")), F.col("label")).alias("items")), "url-baskets")
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / max(n, 1), minConfidence=min_confidence).fit(baskets)
    rules = (model.associationRules.where((F.element_at("consequent", 1) == BAD) & ~F.array_contains("antecedent", GOOD))
             .select(F.array_sort("antecedent").alias("antecedent"), F.size("antecedent").alias("n_items"),
                     F.col("confidence"), F.col("support")))
    return _pruned(written(rules, "url-rules")), groups


def _groups(rows: DataFrame, least: int) -> DataFrame:
    """(feature, item) of the features that at least ``least`` rows have; the item is the first of those of the same rows.

    Equal sets of rows are told by their size and 128 bits of hash.
    """
    had = rows.select(F.xxhash64("row").alias("h1"), F.xxhash64(F.lit(1), "row").alias("h2"), F.explode("features").alias("feature"))
    marks = had.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")).where(F.col("n") >= least)
    marks = written(marks, "url-features")
    first = marks.groupBy("n", "h1", "h2").agg(F.min("feature").alias("item"))
    return written(marks.join(first, ["n", "h1", "h2"]).select("feature", "item"), "url-groups")


def _pruned(rules: DataFrame) -> DataFrame:
    """Without rules of which another one, with fewer features out of theirs, is as confident.

    A rule is compared with those one feature shorter, by an equi-join on the shortened feature list; a longer way
    down goes step by step, as every sub-list of a frequent list is frequent and was mined if confident.
    """
    parts = rules.select("antecedent", "confidence", F.explode("antecedent").alias("out")).select(
        "antecedent", "confidence", F.array_remove("antecedent", F.col("out")).alias("part"))
    short = rules.select(F.col("antecedent").alias("part"), F.col("confidence").alias("part_confidence"))
    weaker = parts.join(short, "part").where(F.col("part_confidence") >= F.col("confidence")).select("antecedent")
    return rules.join(weaker.distinct(), "antecedent", "left_anti")


def inverted_index(rules: DataFrame) -> DataFrame:
    """Each rule under the one of its items that fewest rules name: (item, antecedent, confidence)."""
    each = rules.select("antecedent", "confidence", F.explode("antecedent").alias("item"))
    named = each.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    rarest = each.join(named, "item").groupBy("antecedent", "confidence").agg(
        F.min(F.struct("n", "item"))["item"].alias("item"))
    return rarest.select("item", "antecedent", "confidence")


def match(rows: DataFrame, rules: DataFrame, features: str = "features", groups: DataFrame | None = None) -> DataFrame:
    """``rows`` (with the array ``features``) with ``rule_confidence``: that of the most confident rule a row matches, or
    null.

    A rule names items; a row matches if it has at least one feature of each.  ``groups`` (feature, item) tells the
    features of an item; without it each feature is its own item.
    """
    own = unused("__signature", rows.columns)
    rules = written(rules, "url-rules-kept")
    items = rules.select(F.explode("antecedent").alias("item")).distinct()
    of = written(items.select(F.col("item").alias("feature"), "item") if groups is None else groups.join(items, "item").select("feature", "item"), "url-items")
    # Features that rules name have enough support: of support s there are at most (features a URL) / s, however many rows.
    known = sorted(r[0] for r in of.select("feature").distinct().collect())
    named = F.array_intersect(features, F.array(*map(F.lit, known)).cast("array<string>")) if known else F.array().cast("array<string>")
    rows = rows.withColumn(own, F.array_join(named, "\u0001"))
    signatures = rows.select(F.col(own).alias("__signature")).where(F.col("__signature") != "").distinct()
    held = (signatures.withColumn("feature", F.explode(F.split("__signature", "\u0001"))).join(of, "feature")
            .groupBy("__signature").agg(F.collect_set("item").alias("held")))
    hits = (held.withColumn("item", F.explode("held")).join(inverted_index(rules), "item")
            .where(F.size(F.array_except("antecedent", "held")) == 0)
            .groupBy("__signature").agg(F.max("confidence").alias("rule_confidence")))
    # Written, so that adaptive execution sees its size (and broadcasts it if small) or can split a hot signature's rows.
    rows = rows.drop("rule_confidence")
    return rows.join(written(hits, "url-hits").withColumnRenamed("__signature", own), own, "left").drop(own)


def judge(pages: DataFrame, labels: DataFrame, rules: tuple[HostRule, ...], url: str = "url", page_id: str = "page_id",
          min_support: float = 0.002, min_confidence: float = 0.7) -> DataFrame:
    """``pages`` with host, path, rule, rule_confidence and verdict.

    ``labels`` has (doc_id, quality, toxic); a page is bad if its row there says low quality or toxic.
    """
    rows = pages.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    own, found = unused("__features", rows.columns), unused("__explicit", rows.columns)
    rows = rows.withColumn(own, features(F.col(url), F.col("host"), F.col("path")))
    told = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias(page_id)).agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    mined, groups = mine(rows.select(page_id, F.col(own).alias("features")).join(told, page_id), min_support, min_confidence=min_confidence)
    out = match(rows, mined, own, groups).withColumn(found, explicit(rules, F.col("host"), F.col("path")))
    return (out.withColumn("rule", F.col(f"{found}.rule"))
            .withColumn("verdict", F.coalesce(f"{found}.verdict", F.when(F.col("rule_confidence").isNotNull(), "block").otherwise("allow")))
            .drop(found, own))
