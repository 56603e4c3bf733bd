"""N-gram Jaccard join by a grouped prefix join.

A document's set is its distinct five-word shingles.  Two documents link when their sets' Jaccard similarity is at
least ``PERCENT`` / 100.  All sets' shingles have one order, rare ones first: by the number of shingles of the corpus
in the same of 2 ** ``ORDER_BITS`` hash buckets (a table of fixed size, counted over all documents), then by hash.  Of a
set with n shingles the first n - ceil(0.8 n) + 1 are its *prefix*; linked sets have a shingle in common there.

1.  Equal sets become one node.  Nodes with the same size and the same prefix become one *group*.
2.  Groups are posted under each shingle of their prefix.  Within a posting list, size and position filters leave the
    group pairs that may link.  A short list gives all of them.  A long one gives each entry a few neighbours by
    size and by hash, and is kept for step 4.
3.  The pairs' first members, and each group's members with its first, are verified against whole sets.  Links form
    components; near copies of one text nearly all meet here, as in a random graph.
4.  What step 3 left out is made up for between different components only: entries of long lists, first with
    the lists' best linked entries and then with all others, other members of group pairs, and members of one group.  Nothing is lost, as documents in one component need no further link.

So a large group of near copies gives a few rows per member and not a row per pair, and the components are those of all
links.  Sets are never collected; a document's shingles meet another's only if the pair is a candidate.

Nulls and edge cases: a text that is null or has no word has an empty set, ``n_shingles`` 0 and links with nothing; a
text of one to four words has one shingle; a null id takes part in nothing and is its own (null) component; repeated
rows share their component; an empty table gives an empty result.  A hash has 64 bits: two of 10 ** 9 different sets
have the same with a chance of 3 percent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotmarket.llm.common import PACKED, gathered, histogram, list_array, mix64, pack_texts, text_bytes, text_steps, unpack_texts, written
from lotmarket.llm.components import components
from lotmarket.llm.shingles import shingle_hashes, word_hashes
from lotmarket.operators.common import join_small

PERCENT = 80
ORDER_BITS = 20
#: Entries up to which a posting list gives all its pairs at once.
SHORT = 16
#: Neighbours with which an entry of a long list is paired.
NEIGHBOURS = 6
#: Entries with many links, of each long list, with which entries of other components are paired.
HUBS = 3
#: Entries of a list that a task holds while others of the list meet them.
CELL = 1 << 9
#: Slots of a sketch: how many of a set's hashes fall into each.
SLOTS = 128
FULL = 2**16 - 1
#: Entries of one long list that are held at a time.
HELD = 1 << 14


def _sets(step: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of a step's texts (column 1): hash and row; not yet distinct."""
    words, rows, _ = word_hashes(*text_bytes(step.column(1)))
    hashes, rows, _ = shingle_hashes(words, rows)
    return hashes, rows


def _distinct(hashes: np.ndarray, rows: np.ndarray, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row, in order of (row, ``order``, hash)."""
    by = np.lexsort((hashes, rows) if order is None else (hashes, order, rows))
    hashes, rows = hashes[by], rows[by]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[new], rows[new]


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """Shingles of the corpus by the leading ORDER_BITS of their hash; docs has (id, text)."""
    return histogram(docs, lambda step: (_sets(step)[0] >> np.uint64(64 - ORDER_BITS)).astype(np.int64), 1 << ORDER_BITS)


def _prefix_length(n: np.ndarray) -> np.ndarray:
    return n - (PERCENT * n + 99) // 100 + 1


def prefixes(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """(id, n, node, grp, prefix, sketch) of every document; docs has (id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in text_steps(batches, "text"):
            hashes, rows = _sets(step)
            hashes, rows = _distinct(hashes, rows, shared.value[(hashes >> np.uint64(64 - ORDER_BITS)).astype(np.int64)])
            n = np.bincount(rows, minlength=step.num_rows)
            starts = np.concatenate([[0], np.cumsum(n)])
            length = np.where(n > 0, _prefix_length(n), 0)
            inside = np.arange(len(hashes)) - starts[rows] < length[rows]
            node, prefix_hash = np.zeros((2, step.num_rows), dtype=np.uint64)
            np.add.at(node, rows, mix64(hashes))
            np.add.at(prefix_hash, rows[inside], mix64(hashes[inside] ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
            slot = rows * SLOTS + (hashes % np.uint64(SLOTS)).astype(np.int64)
            sketch = np.minimum(np.bincount(slot, minlength=step.num_rows * SLOTS), FULL).astype(np.uint16).reshape(-1, SLOTS)
            yield pa.RecordBatch.from_arrays(
                [step.column(0), pa.array(n.astype(np.int64)), pa.array(mix64(node + n.astype(np.uint64)).view(np.int64)),
                 pa.array(mix64(prefix_hash + n.astype(np.uint64)).view(np.int64)), list_array(hashes[inside].view(np.int64), length),
                 pa.array([x.tobytes() for x in sketch], pa.binary())],
                names=["id", "n", "node", "grp", "prefix", "sketch"])

    return docs.mapInArrow(run, "id bigint, n bigint, node bigint, grp bigint, prefix array<bigint>, sketch binary")


def _may_link(n1: np.ndarray, n2: np.ndarray, p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
    """Size and position filter for sets of sizes n1, n2 whose first common shingle is at p1, p2."""
    least = -(-PERCENT * (n1 + n2) // (100 + PERCENT))
    return (100 * np.minimum(n1, n2) >= PERCENT * np.maximum(n1, n2)) & (1 + np.minimum(n1 - p1, n2 - p2) - 1 >= least)


def _sketches(column: pa.Array) -> np.ndarray:
    """A row of counts for each entry; one without a sketch counts as full everywhere."""
    full = np.full(SLOTS, FULL, dtype=np.uint16).tobytes()
    return np.frombuffer(b"".join(full if x is None else x for x in column.to_pylist()), dtype=np.uint16).reshape(-1, SLOTS)


def _enough(n1: np.ndarray, n2: np.ndarray, s1: np.ndarray, s2: np.ndarray) -> np.ndarray:
    """Whether sets can have enough in common to link: at most the lesser count of every slot.

    Counts stop at FULL, so a sketch with a full slot (some 8 million shingles) tells nothing and sets may link.
    """
    full = (np.maximum(s1, s2) == FULL).any(axis=-1)
    return full | (np.minimum(s1, s2).sum(axis=-1, dtype=np.int64) >= -(-PERCENT * (n1 + n2) // (100 + PERCENT)))


#: Out of the posting lists: a pair of groups, or (``other`` null) an entry of a long list.
_POSTED = "token bigint, grp bigint, n bigint, place bigint, other bigint"


def posted_pairs(groups: DataFrame) -> DataFrame:
    """Pairs of groups (grp, n, prefix) that may link, and the entries of long lists."""
    entries = groups.select(F.posexplode("prefix").alias("place", "token"), "n", "grp").select(
        "token", "grp", "n", F.col("place").cast("bigint").alias("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, long_token = np.empty((4, 0), dtype=np.int64), None

        def lists(x: np.ndarray) -> Iterator[pa.RecordBatch]:
            """All pairs and entries of whole lists; x has the rows (token, grp, n, place)."""
            token, grp, n, place = x
            starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(token)]]))
            size = np.repeat(sizes, sizes)
            is_long = (size > SHORT) | (token == long_token) if long_token is not None else size > SHORT
            left, right = [], []
            for d in range(1, min(SHORT, int(sizes.max()))):
                both = token[:-d] == token[d:]
                at = np.flatnonzero(both & ~is_long[:-d])
                left.append(at), right.append(at + d)
            by = np.flatnonzero(is_long)
            by = by[np.lexsort((grp[by], token[by]))]  # an order that all lists share, so that lists repeat their pairs
            for d in range(1, NEIGHBOURS + 1):
                i, j = by[:-d], by[d:]
                same = token[i] == token[j]
                left.append(i[same]), right.append(j[same])
            a, b = np.concatenate(left), np.concatenate(right)
            ok = _may_link(n[a], n[b], place[a], place[b])
            a, b = a[ok], b[ok]
            e = np.flatnonzero(is_long)
            at = np.concatenate([a, e])
            other = pa.array(np.concatenate([grp[b], np.zeros(len(e), np.int64)]), mask=np.arange(len(at)) >= len(a))
            yield pa.RecordBatch.from_arrays([pa.array(token[at]), pa.array(grp[at]), pa.array(n[at]), pa.array(place[at]), other],
                                             names=["token", "grp", "n", "place", "other"])

        for batch in gathered(batches):
            x = np.stack([batch.column(i).to_numpy() for i in range(4)])
            x = np.concatenate([carried, x], axis=1)
            cut = int(np.searchsorted(x[0], x[0, -1])) if x.shape[1] else 0
            if cut:
                yield from lists(x[:, :cut])
                long_token = None
            carried = x[:, cut:]
            if carried.shape[1] > HELD:  # a long list: what has come of it goes, the rest counts as long too
                long_token = int(carried[0, 0])
                yield from lists(carried)
                carried = carried[:, :0]
        if carried.shape[1]:
            yield from lists(carried)

    spark = groups.sparkSession
    dealt = entries.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "token")
    return dealt.sortWithinPartitions("token", "n", "grp").mapInArrow(run, _POSTED)


def _mixed_lists(entries: DataFrame) -> DataFrame:
    """The entries of those long lists that hold more than one component, with ``band`` and ``outer``.

    Bands are of sizes within a factor of 1.26, so sets that may link (a factor of 1.25 at most) are in one band or in two
    next to each other.  ``outer`` are the entries outside their list's largest component.
    """
    sizes = entries.groupBy("token", "component").agg(F.count(F.lit(1)).alias("size"))
    several = sizes.groupBy("token").agg(F.max_by("component", "size").alias("largest"), F.count(F.lit(1)).alias("several")).where("several > 1")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.26)))
    return written(join_small(entries, several.select("token", "largest"), ["token"], "inner").select(
        "token", "n", "place", "grp", "component", "degree", "sketch", band.alias("band"), (F.col("component") != F.col("largest")).alias("outer")), "jaccard-mixed")


_CELL_KEYS = ["token", "band", "part", "share"]


def _cells(kept: DataFrame, probes: DataFrame) -> DataFrame:
    """Kept entries and probes of each list, dealt so that a probe meets each kept entry of its own and the next bands once.

    The kept entries of a (token, band) are cut by hash into parts of about CELL, its probes into shares of about CELL; each
    part meets each share in a cell.  A list of any length is so read by as many tasks as it has cells.
    """
    reach = probes.withColumn("band", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)))
    cut = lambda t, c: t.groupBy("token", "band").agg(F.ceil(F.count(F.lit(1)) / CELL).alias(c))
    cells = written(cut(kept, "parts").join(cut(reach, "shares"), ["token", "band"]), "jaccard-cells")

    def dealt(t: DataFrame, own: str, count: str, other: str, others: str, probe: int, outer: Column) -> DataFrame:
        placed = join_small(t, cells, ["token", "band"], "inner")
        return placed.withColumn(own, F.pmod(F.xxhash64("grp", "component"), F.col(count))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(others) - 1))).select(
                *_CELL_KEYS, F.lit(probe).cast("bigint").alias("probe"), "n", "place", "grp", "component", outer.cast("bigint").alias("outer"), "sketch")

    rows = dealt(kept, "part", "parts", "share", "shares", 0, F.col("outer")).union(
        dealt(reach, "share", "shares", "part", "parts", 1, F.lit(True)))
    tasks = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, *_CELL_KEYS).sortWithinPartitions(*_CELL_KEYS, "probe", "n", "grp")


def _met(cells: DataFrame) -> DataFrame:
    """Pairs (ga, ca, gb, cb) of units of different components that meet in a cell and may link, by sizes, places and sketches.

    Two outer entries probe each other; the pair is given once, for the probe with the greater (grp, component).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, marks = np.empty((10, 0), dtype=np.int64), np.empty((0, SLOTS), dtype=np.uint16)
        for batch in gathered(batches):
            x = np.concatenate([held, np.stack([batch.column(i).to_numpy() for i in range(10)])], axis=1)
            sketch = np.concatenate([marks, _sketches(batch.column(10))])
            probe, n, place, grp, comp, outer = x[4:]
            new = np.concatenate([[True], (x[:4, 1:] != x[:4, :-1]).any(axis=0)])
            cell = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            kept = np.bincount(cell, weights=probe == 0).astype(np.int64)
            for j in np.flatnonzero(probe):
                i = np.arange(first[cell[j]], first[cell[j]] + kept[cell[j]])
                twice = (outer[i] == 1) & ((grp[i] > grp[j]) | ((grp[i] == grp[j]) & (comp[i] > comp[j])))
                i = i[(comp[i] != comp[j]) & ~twice]
                i = i[_may_link(n[i], n[j], place[i], place[j])]
                i = i[_enough(n[i], n[j], sketch[i], sketch[j])]
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (grp[i], comp[i], np.full(len(i), grp[j]), np.full(len(i), comp[j]))],
                                                     names=["ga", "ca", "gb", "cb"])
            stay = np.flatnonzero((cell == cell[-1]) & (probe == 0))
            held, marks = x[:, stay], sketch[stay]

    return cells.mapInArrow(run, "ga bigint, ca bigint, gb bigint, cb bigint").distinct()


def _hub_pairs(entries: DataFrame) -> DataFrame:
    """The HUBS hubs of each long list with those of its entries that are in other components.

    A hub is the entry with most links of those in one of HUBS parts of the list by hash.  Near copies of one text link
    the better the fewer their changes, so hubs join nearly all others.
    """
    mixed = _mixed_lists(entries)
    best = mixed.groupBy("token", F.pmod(F.xxhash64("grp"), F.lit(HUBS)).alias("of")).agg(
        F.max(F.struct("degree", "grp", "component", "n", "place", "band", "sketch")).alias("hub"))
    return _met(_cells(mixed.withColumn("outer", F.lit(False)), best.select("token", "hub.*")))


def _cross_pairs(entries: DataFrame) -> DataFrame:
    """All pairs of units of different components that may link and have a long list in common.

    One of the two at least is outside the list's largest component, so only the outer entries probe.
    """
    mixed = _mixed_lists(entries)
    return _met(_cells(mixed, mixed.where("outer")))


def whole_sets(members: DataFrame, docs: DataFrame, many: bool) -> DataFrame:
    """(node, hashes) of the nodes in members (node, rep), once for each row with its id; docs has (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in text_steps(batches, PACKED if many else "text"):
            texts = pa.array(unpack_texts(step.column(1)), pa.binary()) if many else step.column(1)
            hashes, rows = _distinct(*_sets(pa.RecordBatch.from_arrays([step.column(0), texts], names=["node", "text"])))
            n = np.bincount(rows, minlength=step.num_rows)
            node = np.zeros(step.num_rows, dtype=np.uint64)
            np.add.at(node, rows, mix64(hashes))
            node = mix64(node + n.astype(np.uint64)).view(np.int64)
            right = pa.array(node == step.column(0).to_numpy())  # of rows with one id, that with the node's set
            yield pa.RecordBatch.from_arrays([step.column(0), list_array(hashes.view(np.int64), n)], names=["node", "hashes"]).filter(right)

    named = written(members.select("node", F.col("rep").alias("id")).hint("rebalance"), "jaccard-named")  # its size is known now
    if many:  # texts are packed, then dealt by id
        texts = pack_texts(docs, "text", ["id"]).join(named.hint("merge"), "id").select("node", PACKED)
    else:  # few nodes as a rule, which go to the texts instead; if they are many, this is a shuffle too
        texts = docs.join(named, "id").select("node", "text")
    return written(texts.mapInArrow(run, "node bigint, hashes array<bigint>"), "jaccard-sets")


def verified(pairs: DataFrame, members: DataFrame, docs: DataFrame, many: bool) -> DataFrame:
    """Those of the node pairs (a, b) whose whole sets link; members has (node, rep, sketch), docs (id, text).

    Pairs' sketches meet first; whole sets are made where these allow a link.
    """

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s1, s2 = _sketches(batch.column(2)), _sketches(batch.column(3))
            n1, n2 = (s.sum(axis=1, dtype=np.int64) for s in (s1, s2))
            yield batch.select([0, 1]).filter(pa.array(_enough(n1, n2, s1, s2)))

    side = lambda t, c, x: t.select(F.col("node").alias(c), F.col(x).alias(x + c))
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "jaccard-pairs")
    marked = pairs.join(side(members, "a", "sketch"), "a").join(side(members, "b", "sketch"), "b").select("a", "b", "sketcha", "sketchb")
    pairs = written(marked.mapInArrow(likely, "a bigint, b bigint"), "jaccard-likely")
    sets = whole_sets(members.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node"), docs, many)
    both = F.size(F.array_intersect("hashesa", "hashesb"))
    union = F.size("hashesa") + F.size("hashesb") - both
    meet = pairs.join(side(sets, "a", "hashes").hint("merge"), "a").join(side(sets, "b", "hashes").hint("merge"), "b")
    return written(meet.where(100 * both >= PERCENT * union).select("a", "b"), "jaccard-links")


def link(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``: the component's smallest id, itself included."""
    docs = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    rows = written(prefixes(docs, bucket_counts(docs)), "jaccard-prefixes")
    full = rows.where((F.col("n") > 0) & F.col("id").isNotNull())
    members = written(full.groupBy("node").agg(F.min("id").alias("rep"), F.first("grp").alias("grp"), F.count(F.lit(1)).alias("copies"),
                                               F.first("sketch").alias("sketch")), "jaccard-nodes")
    groups = full.groupBy("grp").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    posted = written(posted_pairs(groups), "jaccard-posted")
    pairs = written(posted.where(F.col("other").isNotNull()).select(
        F.least("grp", "other").alias("ga"), F.greatest("grp", "other").alias("gb")).distinct(), "jaccard-group-pairs")

    # Step 3: first members of group pairs, and every member of a group with its first.
    size = written(members.groupBy("grp").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("size")), "jaccard-groups")
    head = size.select("grp", "head")
    between = (pairs.join(head.select(F.col("grp").alias("ga"), F.col("head").alias("a")), "ga")
               .join(head.select(F.col("grp").alias("gb"), F.col("head").alias("b")), "gb").select("a", "b"))
    within = members.join(size.where("size > 1"), "grp").select(F.col("node").alias("a"), F.col("head").alias("b"))
    listed = pairs.select(F.explode(F.array("ga", "gb")).alias("grp")).union(posted.where("other is null").select("grp")).union(
        size.where("size > 1").select("grp")).distinct()
    listed = written(listed, "jaccard-listed")
    known = written(members.join(listed, "grp", "left_semi").select("node", "rep", "grp", "sketch"), "jaccard-known")
    links = verified(between.union(within), known, docs, True)

    # Step 4: between different components only.
    large = size.where("size > 1").select("grp")
    touching = written(pairs.join(large.withColumnRenamed("grp", "ga"), "ga", "left_semi").union(
        pairs.join(large.withColumnRenamed("grp", "gb"), "gb", "left_semi").select("ga", "gb")).union(
        large.select(F.col("grp").alias("ga"), F.col("grp").alias("gb"))).distinct(), "jaccard-touching")
    entries = posted.where("other is null").select("token", "n", "place", "grp")

    def linked(links: DataFrame, hubs: bool) -> DataFrame:
        """The links and more of them: from long lists' hubs, or from all pairs of units that are left."""
        component = components(links)
        degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
        unit = written(known.join(component, "node", "left").join(degree, "node", "left").select(
            "node", "grp", "sketch", F.coalesce("component", "node").alias("component"), F.coalesce("degree", F.lit(0)).alias("degree")), "jaccard-units")
        kinds = written(unit.groupBy("grp", "component").agg(
            F.max("degree").alias("degree"), F.when(F.count(F.lit(1)) == 1, F.first("sketch")).alias("sketch")), "jaccard-kinds")
        listing = entries.join(kinds, "grp")
        if hubs:
            across = _hub_pairs(listing)
        else:
            side = lambda g, c: kinds.select(F.col("grp").alias(g), F.col("component").alias(c))
            within = touching.join(side("ga", "ca"), "ga").join(side("gb", "cb"), "gb").where("ca <> cb")
            across = _cross_pairs(listing).union(within.select("ga", "ca", "gb", "cb"))
        more = (across.join(unit.select(F.col("grp").alias("ga"), F.col("component").alias("ca"), F.col("node").alias("a")), ["ga", "ca"])
                .join(unit.select(F.col("grp").alias("gb"), F.col("component").alias("cb"), F.col("node").alias("b")), ["gb", "cb"]))
        return links.union(verified(more.select("a", "b"), known, docs, False))

    component = components(linked(linked(links, True), False))

    # A component's smallest id, back to all rows by their node; nodes alone, of one row, need no way back.
    named = members.drop("sketch").join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    label = written(named.join(least, "component").where((F.col("copies") > 1) | (F.col("component_id") != F.col("rep")))
                    .select("node", "component_id"), "jaccard-labels")
    return rows.drop("prefix", "sketch").join(label, "node", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.coalesce("component_id", "id")).otherwise(F.col("id")).alias("component_id"))


def one_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id.

    Rows without an id stay.  Rows that share an id stay or go together, and equal ones of them become one.
    """
    rows = written(link(docs, text, doc_id), "jaccard-rows").where("doc_id IS NOT NULL")
    by_id = rows.groupBy("doc_id").agg(F.min(F.col("doc_id") != F.col("component_id")).alias("copy"), F.count(F.lit(1)).alias("n"))
    marked = written(by_id.where("copy OR n > 1").withColumnRenamed("doc_id", "__id"), "jaccard-marked")
    match = F.col(doc_id) == F.col("__id")
    alone = docs.join(marked, match, "left_anti")
    shared = docs.join(marked.where("NOT copy"), match, "left_semi").dropDuplicates([doc_id, text])
    return alone.unionByName(shared)
