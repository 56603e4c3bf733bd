"""A Merkle manifest of a dataset, with a proof for each row, by a butterfly exchange.

Rows are leaves.  Within a source, ordered by id, every ``fanout`` consecutive nodes become one until a single *subroot*
is left; the subroots in the order of their sources become the *root* likewise.

1. Each row is hashed where it is read; from here on only digests move.  A global sort by (source, id) and the counts of
   its partitions give every leaf its place, so a source that holds a third of all rows is spread over many tasks.
2. A *block* is an aligned run of ``fanout ** block_levels`` leaves of one source; it hashes its own subtree.
3. Rounds of a butterfly exchange: in round r, aligned groups of up to ``fanout`` blocks, one below each of the nodes
   that become one parent, swap these nodes' digests.  Each member hashes the parent for itself and notes the siblings,
   so after the last round every block knows the root and the upper part of its proofs, without a downward pass.  A
   node with fewer blocks below it than its siblings have sends copies, so that each group is whole; a group never has
   more than ``fanout`` members.  After the rounds within sources, those between sources go the same way.
4. A block's leaves get their proofs: siblings within the block, then the block's own.

A proof is a list of (left, right), the joined digests of the siblings on either side, from the leaf's level upwards;
``folded`` gives the root that a leaf and a proof lead to.

Nulls and edge cases: a null field is hashed as ``-``; rows without a source are a source of its own, before all others;
a null id comes before all others; rows with one id in one source are ordered by their digests, so repeated rows can
stand in either order.  A lone leaf is its subroot, a lone subroot the root, and a lone row's proof is empty.  An empty
table has no rows.  Only the named columns matter; others may have any name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotmarket.llm.common import written

FANOUT = 16
BLOCK_LEVELS = 3
_PROOF = "array<struct<left:string,right:string>>"
_ROUTE = "array<struct<shift:bigint,width:bigint,wide:bigint>>"


def field(value: Column) -> Column:
    """How a value is written into its row's hash: its length in bytes, a colon, the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root to which a leaf and its proof lead."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_text(proof: Column) -> Column:
    """All siblings' digests of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), "")


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by))


def _digest(nodes: Column) -> Column:
    return F.sha2(F.array_join(nodes, ""), 256)


def _siblings(nodes: Column, k: Column, fanout: int) -> Column:
    return F.struct(F.array_join(F.slice(nodes, F.lit(1), k), "").alias("left"),
                    F.array_join(F.slice(nodes, k + 2, F.lit(fanout)), "").alias("right"))


def _rounds(n: int, fanout: int) -> int:
    """Levels above n nodes."""
    out = 0
    while n > 1:
        n, out = -(-n // fanout), out + 1
    return out


def _sources(runs: DataFrame, size: int) -> DataFrame:
    """A row for each source, from its first run: ``s`` (its number in order), ``n_leaves``, ``n_blocks`` and ``base``
    (blocks of all sources before it)."""
    firsts = runs.where("before = 0").withColumn("n_blocks", F.ceil(F.col("n_leaves") / size).cast("long"))
    inside = Window.partitionBy("pid").orderBy("start")
    firsts = firsts.select("pid", "source", "n_leaves", "n_blocks", F.row_number().over(inside).alias("nth"),
                           (F.sum("n_blocks").over(inside) - F.col("n_blocks")).alias("blocks_inside"))
    # One row for each partition of the sort.
    parts = firsts.groupBy("pid").agg(F.count(F.lit(1)).alias("c"), F.sum("n_blocks").alias("b"))
    up_to = Window.orderBy("pid")
    parts = parts.select("pid", (F.sum("c").over(up_to) - F.col("c")).alias("c"), (F.sum("b").over(up_to) - F.col("b")).alias("b"))
    return firsts.join(parts, "pid").select("source", "n_leaves", "n_blocks", (F.col("c") + F.col("nth") - 1).alias("s"),
                                            (F.col("b") + F.col("blocks_inside")).alias("base"))


def _routed(sources: DataFrame, rounds: int, fanout: int) -> DataFrame:
    """``sources`` with ``route``: for each round between sources, the source's first place below its node (``shift``),
    the blocks below that node (``width``) and below the widest of its siblings (``wide``)."""
    for r in range(rounds):
        at = _div(F.col("s"), fanout**r).alias("node")
        nodes = sources.groupBy(at).agg(F.min("base").alias("first"), F.sum("n_blocks").alias("width"))
        wide = nodes.groupBy(_div(F.col("node"), fanout).alias("up")).agg(F.max("width").alias("wide"))
        nodes = nodes.withColumn("up", _div(F.col("node"), fanout)).join(wide, "up").drop("up")
        sources = sources.withColumn("node", at).join(nodes, "node").withColumn(
            f"r{r}", F.struct((F.col("base") - F.col("first")).alias("shift"), "width", "wide")).drop("node", "first", "width", "wide")
    route = F.array(*[F.col(f"r{r}") for r in range(rounds)]) if rounds else F.array().cast(_ROUTE)
    return sources.select("source", "s", "n_leaves", "n_blocks", route.alias("route"))


def _exchange(state: DataFrame, scope: Column, node: Column, place: Column, width: Column, wide: Column, active: Column, fanout: int) -> DataFrame:
    """One round.  Blocks below ``node`` (a number among its siblings' and theirs) are numbered by ``place``, of ``width``;
    the blocks with one place below each of up to ``fanout`` siblings are a group.  Blocks that aren't ``active`` are
    groups of their own and stay as they are."""
    own = F.struct(*state.columns)
    sent = state.select(
        F.when(active, scope).otherwise(F.col("s")).alias("g1"), F.when(active, _div(node, fanout)).otherwise(F.col("block")).alias("g2"),
        node.alias("a"), "node", own.alias("own"), place.alias("place"),
        F.explode(F.when(active, F.sequence(place, wide - 1, width)).otherwise(F.array(F.lit(-1).cast("long")))).alias("g3"))
    # Beyond its own place a block sends copies, which carry its digest only.
    member = F.struct("a", "node", F.when((F.col("g3") == F.col("place")) | (F.col("g3") < 0), F.col("own")).alias("own"))
    groups = sent.groupBy("g1", "g2", "g3").agg(F.sort_array(F.collect_list(member)).alias("members"))
    groups = groups.withColumn("nodes", F.transform("members", lambda m: m["node"]))
    groups = groups.withColumn("parent", F.when(F.col("g3") >= 0, _digest(F.col("nodes"))))
    each = groups.select("parent", "nodes", F.posexplode("members").alias("k", "m")).where("m.own IS NOT NULL")
    done = F.col("parent").isNotNull()
    rest = [F.col(f"m.own.{c}") for c in state.columns if c not in ("node", "proof")]
    return each.select(*rest, F.coalesce("parent", "m.own.node").alias("node"), F.when(done, F.concat(
        "m.own.proof", F.array(_siblings(F.col("nodes"), F.col("k"), fanout)))).otherwise(F.col("m.own.proof")).alias("proof"))


def _leaf_proofs(blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """A row for each leaf of ``blocks`` (arrays ``leaves``, ``l1`` .. by level, and ``proof`` of the whole block)."""
    keep = ["n_leaves", "subroot", "root"]
    for level in reversed(range(levels)):
        nodes = F.transform("leaves", lambda x: x["leaf"]) if level == 0 else F.col(f"l{level}")
        blocks = blocks.withColumn("nodes", nodes)
        part = lambda name, k, of: F.slice(name, k * fanout**(level - of) + 1, F.lit(fanout**(level - of))).alias(name)  # noqa: B023,E731
        child = F.transform("nodes", lambda _, k: F.struct(
            _siblings(F.col("nodes"), k, fanout).alias("step"), part("leaves", k, 0), *[part(f"l{j}", k, j) for j in range(1, level)]))  # noqa: B023
        blocks = blocks.select(*keep, "proof", F.explode(child).alias("x")).select(
            *keep, F.when(F.col("n_leaves") > fanout**level, F.concat(F.array("x.step"), "proof")).otherwise(F.col("proof")).alias("proof"),
            "x.leaves", *[f"x.l{j}" for j in range(1, level)])
    one = F.col("leaves").getItem(0)
    return blocks.select(one["carry"].alias("carry"), one["leaf"].alias("leaf"), "proof", "subroot", "root")


def manifest(docs: DataFrame, fields: Sequence[str], source: str = "source", order: str = "doc_id",
             carry: Mapping[str, Column] | None = None, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """A row for each row of ``docs``: the columns of ``carry`` (``order`` unless given), ``leaf`` (digest of ``fields``),
    ``proof``, ``subroot`` and ``root``."""
    carry = dict(carry or {order: F.col(order)})
    size = fanout**block_levels
    leaves = written(docs.select(F.col(source).alias("source"), F.col(order).alias("ord"), leaf_digest([F.col(c) for c in fields]).alias("leaf"),
                                 F.struct(*[v.alias(k) for k, v in carry.items()]).alias("carry")), "merkle-leaves")
    leaves = leaves.orderBy(F.col("source").asc_nulls_first(), F.col("ord").asc_nulls_first(), "leaf")
    leaves = written(leaves.withColumn("at", F.monotonically_increasing_id()), "merkle-sorted").withColumn("pid", F.shiftright("at", 33))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1))
    runs = written(leaves.groupBy("pid", "source").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("start"))
                   .select("pid", "source", "start", F.coalesce(before, F.lit(0)).alias("before"),
                           F.sum("n").over(Window.partitionBy("source")).alias("n_leaves")), "merkle-runs")
    sources = written(_sources(runs, size), "merkle-sources")
    n_sources, widest = sources.agg(F.count(F.lit(1)), F.coalesce(F.max("n_blocks"), F.lit(0))).first()
    between = _rounds(n_sources, fanout)
    sources = _routed(sources, between, fanout).withColumnRenamed("source", "its")
    spots = runs.drop("n_leaves").join(sources, F.col("source").eqNullSafe(F.col("its"))).drop("its").withColumnsRenamed({"pid": "p", "source": "its"})
    ranked = (leaves.join(spots, (F.col("pid") == F.col("p")) & F.col("source").eqNullSafe(F.col("its")))
              .withColumn("rank", F.col("at") - F.col("start") + F.col("before")))
    route = F.first(F.when(F.col("rank") % size == 0, F.col("route")), ignorenulls=True)
    blocks = ranked.groupBy("s", _div(F.col("rank"), size).alias("block")).agg(
        F.max("n_leaves").alias("n_leaves"), F.max("n_blocks").alias("n_blocks"), route.alias("route"),
        F.sort_array(F.collect_list(F.struct("rank", "leaf", "carry"))).alias("leaves"))
    blocks = blocks.withColumn("l0", F.transform("leaves", lambda x: x["leaf"]))
    for level in range(block_levels):
        below = F.col(f"l{level}")
        up = F.transform(F.sequence(F.lit(0), F.floor((F.size(below) - 1) / fanout).cast("int")),
                         lambda i: _digest(F.slice(below, i * fanout + 1, F.lit(fanout))))  # noqa: B023
        blocks = blocks.withColumn(f"l{level + 1}", F.when(F.col("n_leaves") > fanout**level, up).otherwise(below))
    blocks = written(blocks.withColumn("node", F.col(f"l{block_levels}").getItem(0)).drop("l0"), "merkle-blocks")

    block, n = F.col("block"), F.col("n_blocks")
    state = blocks.select("s", "block", "n_blocks", "route", "node", F.array().cast(_PROOF).alias("proof"))
    for r in range(_rounds(widest, fanout)):
        below = fanout**r
        node = _div(block, below)
        first = _div(block, below * fanout) * (below * fanout)
        state = _exchange(state, F.col("s"), node, block % below, F.least(F.lit(below), n - node * below), F.least(F.lit(below), n - first), n > below, fanout)
    state = state.withColumn("subroot", F.col("node"))
    for r in range(between):
        way = F.col("route").getItem(r)
        state = _exchange(state, F.lit(-1).cast("long"), _div(F.col("s"), fanout**r), block + way["shift"], way["width"], way["wide"], F.lit(True), fanout)
    whole = blocks.drop("route", "n_blocks", "node").join(state.select("s", "block", "proof", "subroot", F.col("node").alias("root")), ["s", "block"])
    return _leaf_proofs(whole, fanout, block_levels).select("carry.*", "leaf", "proof", "subroot", "root")
