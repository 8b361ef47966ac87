"""Story grouping.

Edge set
--------
Edges are directed from a later item to an earlier one (by ``ord``):

* same link (C3): a chain — each item points at the previous item with
  the same link;
* same non-empty title key: a chain likewise (equal keys are always
  similar: containment for 5+ characters, ratio 1.0 below);
* similar distinct keys (C4/C5), when an ``x``-item after a ``y``-item is
  similar (the verdict can depend on the order): each item of the rarer key
  is tied to its nearest item of the other key, the latest ``y`` before an
  ``x`` or the next ``x`` after a ``y``. The chains carry the rest.

Chains and as-of edges come from :func:`latest_before`, so no group ever
emits all of its pairs and no hot key lands in one task.

Exact first-fit (C6)
--------------------
The reference appends each item to the first existing group that holds a
direct match, groups never merge. Numbering groups by their first item,
an item's group leader is the leader with the smallest ``ord`` among its
earlier matches, i.e. the smallest ``ord`` reachable from the item along
edges that always step to an earlier item. A chain keeps exactly that
reachability for a clique (every earlier member stays reachable), and an
as-of edge plus the target key's chain reach every earlier item of that
key. So the leader is a fixed point of min-label propagation along the
directed edges. Blocks of consecutive items go to their own fixed point first; edges
between blocks are settled by a distributed join loop with doubling pointers for long chains,
with nothing per group in memory, that runs until no label changes. Rounds are logarithmic on chains;
a graph in which best paths alternate often between chains of different blocks takes a round or more per alternation.

Components (C7) are the same loop over the undirected edges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.functions.text import title_key
from storyloom.operators.asof import DEFAULT_BUCKET_BITS, latest_before
from storyloom.operators.candidates import distinct_keys, numbered_keys, similar_key_ids
from storyloom.operators.materialize import collect_garbage, mark, materialize, release
from storyloom.params import CONTAINMENT_MIN_LEN


def grouping_items(df: DataFrame, digest_key=None) -> DataFrame:
    """Narrow projection used by the grouping plan: ids, ord, keys, link."""
    dk = F.lit("") if digest_key is None else F.coalesce(F.col(digest_key).cast("string"), F.lit(""))
    return df.select("item_id", "ord", dk.alias("digest_key"),
                     title_key("title").alias("key"), F.col("link"))


def story_edges(items: DataFrame, threshold: float = 0.65, use_ratio: bool = True,
                bucket_bits: int = DEFAULT_BUCKET_BITS) -> DataFrame:
    """Directed edges (src, dst), src later than dst; ``items`` from
    :func:`grouping_items`.

    Links and equal titles are one as-of lookup over a tagged group key
    (``L``+link, ``K``+title key); similar titles are looked up from the
    rarer title's side.
    """
    # texts of keys are compared once; from here on a key is its number
    keys = numbered_keys(distinct_keys(items))
    digest = F.unhex(F.sha2("key", 256)).alias("digest")
    number_of = keys.select("digest_key", digest, "kid", "klen")
    base = materialize(items.select("digest_key", "link", "ord", digest).join(number_of, ["digest_key", "digest"], "left")
                       .drop("digest"), "keyed-items")
    link_g = base.select("digest_key", F.concat(F.lit("L"), "link").alias("g"), "ord")
    keyed = base.filter(F.col("kid").isNotNull())
    if not use_ratio:  # equal keys below 5 characters match only by ratio
        keyed = keyed.filter(F.col("klen") >= CONTAINMENT_MIN_LEN)
    key_g = keyed.select("digest_key", F.concat(F.lit("K"), F.col("kid").cast("string")).alias("g"), "ord")
    e = latest_before(link_g.unionByName(key_g), link_g.unionByName(key_g), ["digest_key", "g"],
                      bucket_bits, with_first=True)
    # chain edge to the latest earlier item, plus a shortcut to the group's
    # first item (also earlier and also a match): groups then settle in a
    # round or two instead of log(size) rounds
    chain = e.filter(F.col("prev").isNotNull()).select(F.col("ord").alias("src"),
                                                       F.col("prev").alias("dst"))
    star = e.filter(F.col("first") < F.col("ord")).select(F.col("ord").alias("src"),
                                                          F.col("first").alias("dst"))

    # each pair of keys as (x later than y) in the orders in which it is similar
    ways = F.array(F.when(F.col("a_later"), F.struct(F.col("a").alias("x"), F.col("b").alias("y"))),
                   F.when(F.col("b_later"), F.struct(F.col("b").alias("x"), F.col("a").alias("y"))))
    directed = similar_key_ids(keys, threshold, use_ratio).select(F.explode(F.array_compact(ways)).alias("p")).select("p.x", "p.y")
    # of a pair, the rarer key's items look the other key up
    # in that key's own list, which all pairs share: at most twice the smaller
    # group's rows per pair, however common the other title is
    listed = base.filter(F.col("kid").isNotNull()).select(F.col("kid").alias("g"), "ord")
    number = listed.groupBy("g").agg(F.count("*").alias("c"))
    sized = directed.join(number.withColumnsRenamed({"g": "x", "c": "nx"}), "x") \
        .join(number.withColumnsRenamed({"g": "y", "c": "ny"}), "y")
    sized = materialize(sized.select("x", "y", (F.col("nx") <= F.col("ny")).alias("few_x")), "directed-pairs")
    # few x: each looks up the latest y before it
    of_x = sized.where("few_x").join(listed.withColumnRenamed("g", "x"), "x").select(F.col("y").alias("g"), "ord")
    back = latest_before(of_x.distinct(), listed, ["g"], bucket_bits) \
        .where("prev is not null").select(F.col("ord").alias("src"), F.col("prev").alias("dst"))
    # few y: each looks up the next x after it (the latest one on the reversed
    # axis); later x reach it by their chain
    of_y = sized.where("not few_x").join(listed.withColumnRenamed("g", "y"), "y").select(F.col("x").alias("g"),
                                                                                         (-F.col("ord")).alias("ord"))
    ahead = latest_before(of_y.distinct(), listed.withColumn("ord", -F.col("ord")), ["g"],
                          bucket_bits).where("prev is not null") \
        .select((-F.col("prev")).alias("src"), (-F.col("ord")).alias("dst"))
    return materialize(chain.unionByName(star).unionByName(back).unionByName(ahead).distinct(), "edges")


#: Blocks of ``2**BLOCK_BITS`` consecutive items, narrower where one would hold more than ``BLOCK_EDGES`` edges.
BLOCK_BITS, BLOCK_EDGES = 18, 4_000_000

SWEPT = "ord long, label long, jump long"


def _sweep(directed: bool):
    """The fixed point inside a block, from its edges and the labels that its nodes have now (their own
    numbers if none are given): labels that are lower than before, and of nodes whose chain of latest
    earlier neighbours leaves the block, where it does."""
    def run(key, edges: pa.Table, labels: pa.Table) -> pa.Table:
        src, dst, base = (edges.column(c).to_numpy(zero_copy_only=False) for c in ("src", "dst", "base"))
        inside = ~np.isnan(dst) if dst.dtype.kind == "f" else np.ones(len(dst), bool)
        own = np.unique(np.concatenate((src, dst[inside].astype(np.int64), labels.column("ord").to_numpy())))
        now = own.copy()
        now[np.searchsorted(own, labels.column("ord").to_numpy())] = labels.column("label").to_numpy()
        was = now.copy()
        s, d = np.searchsorted(own, src[inside]), np.searchsorted(own, dst[inside].astype(np.int64))
        if directed:
            # targets come before sources, so one pass in the order of sources is enough
            order = np.argsort(s, kind="stable")
            out = now.tolist()
            for i, j in zip(s[order].tolist(), d[order].tolist()):
                if out[j] < out[i]:
                    out[i] = out[j]
            now = np.array(out, np.int64)
        else:
            root = np.arange(len(own))
            while True:  # hook the larger root below the smaller, then shorten the ways
                a, b = root[s], root[d]
                low = np.minimum(a, b)
                np.minimum.at(root, a, low)
                np.minimum.at(root, b, low)
                while (root[root] != root).any():
                    root = root[root]
                if (root[s] == root[d]).all():
                    break
            least = now.copy()
            np.minimum.at(least, root, now)
            now = least[root]
        jump = {}
        for i, b in sorted({(int(i), int(b)) for i, b in zip(src, base) if b == b and b >= 0}):
            at = jump.get(b) if b >> int(edges.column("bits")[0].as_py()) == key[0].as_py() else b
            if at is not None:
                jump[i] = at
        out = np.flatnonzero(now < was)
        n = len(out)
        return pa.table({"ord": pa.array([*own[out].tolist(), *jump], pa.int64()),
                         "label": pa.array([*now[out].tolist(), *[None] * len(jump)], pa.int64()),
                         "jump": pa.array([*[None] * n, *jump.values()], pa.int64())})
    return run


def _fitting_bits(edges: DataFrame, bits: int) -> int:
    """Bits of a block's width, so that no block has more than ``BLOCK_EDGES`` edges inside."""
    while bits > 0:
        block = F.shiftright("src", bits)
        most = edges.groupBy(block.alias("block")).count().agg(F.max("count")).first()[0] or 0
        if most <= BLOCK_EDGES:
            break
        bits -= 2
    return max(bits, 0)


def propagate_min(nodes: DataFrame, edges: DataFrame, directed: bool = True,
                  block_bits: int | None = None, rounds: list | None = None) -> DataFrame:
    """Fixed point of ``L(i) = min(L(i), L(j) for edges i->j)``, starting from
    ``L(i) = i``. Returns (ord, label). The loop ends when no label changes,
    after however many rounds that takes; ``rounds`` gets the number of lowered labels of each.

    Nodes are cut into blocks of consecutive numbers. Each block first goes to its own fixed point
    over the edges inside it, in one task. If no edge leaves its block, that is all. Otherwise rounds
    follow, over the edges between blocks only: a node takes the labels of targets
    that just changed, its label's own label, and the label of its jump
    pointer (where its chain of latest earlier neighbours leaves the block; pointers double every
    round, so a chain over many blocks takes a logarithm of them). Only what a proposal
    lowers is aggregated and updated, and only blocks that it touches go to
    their fixed point again. Undirected runs add the hooking step, which serves paths whose order zig-zags.

    Every round is written to the checkpoint folder, so a lost executor costs at most the round.
    """
    edges = materialize(edges.where("src <> dst").select("src", "dst"), "edges-whole")
    bits = _fitting_bits(edges, BLOCK_BITS if block_bits is None else block_bits)

    def block(c):
        return F.shiftright(c, bits)
    latest = edges.where("dst < src").groupBy("src").agg(F.max("dst").alias("base"))
    inner = edges.where(block("src") == block("dst"))
    cross = edges.where(block("src") != block("dst"))
    none = F.lit(None).cast("long")
    crossing = cross.limit(1).count() > 0
    # the latest earlier neighbour matters only where edges leave blocks
    inside = inner.select(block("src").alias("block"), "src", "dst", none.alias("base"), F.lit(bits).alias("bits"))
    first = inside if not crossing else inside.unionByName(
        latest.select(block("src").alias("block"), "src", none.alias("dst"), "base", F.lit(bits).alias("bits")))
    no_labels = nodes.select(block("ord").alias("block"), "ord", F.col("ord").alias("label")).where(F.lit(False))
    swept = materialize(first.groupBy("block").cogroup(no_labels.groupBy("block")).applyInArrow(_sweep(directed), SWEPT), "swept")
    low = swept.groupBy("ord").agg(F.min("label").alias("low"), F.max("jump").alias("jump"))
    state = materialize(nodes.select("ord").join(low, "ord", "left")
                        .select("ord", F.coalesce("low", "ord").alias("label"), "jump"), "labels")
    if rounds is not None:
        rounds.append(state.where("label <> ord").count())
    if not crossing:
        return state.select("ord", "label")
    if not directed:
        cross = cross.unionByName(cross.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    cross = materialize(cross, "edges-cross")
    base = state.select("ord", F.col("jump").alias("base"))
    inside = materialize(inside.drop("base"), "edges-inside")
    delta = state.select("ord", "label")  # labels that changed in the previous round (all, at first)
    while True:
        labels = state.select("ord", "label")
        # semi-naive: an edge can only lower its source if its target's label
        # just changed; every edge still sees each target's final label in the
        # round after that label last changed, so the fixed point is unchanged
        via_edge = cross.join(delta.select(F.col("ord").alias("dst"), F.col("label").alias("l")),
                              "dst").select(F.col("src").alias("ord"), F.col("l").alias("label"))
        own = labels.where("label <> ord").select(F.col("ord").alias("i"), F.col("label").alias("j"))
        via_label = own.join(labels, own["j"] == labels["ord"]).select(F.col("i").alias("ord"), "label")
        ptr = state.where("jump is not null").select(F.col("ord").alias("i"), F.col("jump").alias("j"))
        target = state.select("ord", "label", F.col("jump").alias("next"))
        via_jump = materialize(ptr.join(target, ptr["j"] == target["ord"])
                               .select(F.col("i").alias("ord"), "label", "next"), "jumps")
        proposals = via_edge.unionByName(via_label).unionByName(via_jump.select("ord", "label"))
        if not directed:
            # hook (Shiloach-Vishkin): a node's current label also takes the
            # smallest label its members see; valid for components only, as
            # first-fit reachability is one-way
            seen = via_edge.groupBy("ord").agg(F.min("label").alias("seen"))
            hooked = seen.join(labels, "ord").where("seen < label").select(F.col("label").alias("ord"), F.col("seen").alias("label"))
            proposals = proposals.unionByName(hooked)
        best = proposals.groupBy("ord").agg(F.min("label").alias("low"))
        low = materialize(best.join(labels, "ord").where("low < label").select("ord", "low"), "lowered")
        # blocks with lowered labels go to their own fixed point again
        touched = low.select(block("ord").alias("block")).distinct()
        now = labels.join(low, "ord", "left").select(block("ord").alias("block"), "ord", F.coalesce("low", "label").alias("label"))
        again = (inside.join(touched, "block", "left_semi").withColumn("base", none).groupBy("block")
                 .cogroup(now.join(touched, "block", "left_semi").groupBy("block")).applyInArrow(_sweep(directed), SWEPT))
        low = materialize(low.unionByName(again.select("ord", F.col("label").alias("low")))
                          .groupBy("ord").agg(F.min("low").alias("low")), "lowered-all")
        changed = low.count()
        if rounds is not None:
            rounds.append(changed)
        if not changed:
            return state.select("ord", "label")
        jumping = via_jump.where("next is not null").limit(1).count() > 0
        jumps = via_jump.select("ord", F.col("next").alias("jump")) if jumping else base.withColumnRenamed("base", "jump")
        state = materialize(state.select("ord", "label").join(low, "ord", "left").join(jumps, "ord", "left")
                            .select("ord", F.coalesce("low", "label").alias("label"), "jump"), "labels")
        delta = low.select("ord", F.col("low").alias("label"))


def assign_groups(items: DataFrame, threshold: float = 0.65, use_ratio: bool = True,
                  exact: bool = True,
                  bucket_bits: int = DEFAULT_BUCKET_BITS) -> DataFrame:
    """(item_id, ord, digest_key, leader_ord): first-fit groups when
    ``exact``, connected components otherwise."""
    since = mark()
    edges = story_edges(items, threshold, use_ratio, bucket_bits)
    release(items.sparkSession, since, mark() - 1)  # all that led to the edges
    collect_garbage(items.sparkSession)
    labels = propagate_min(items.select("ord"), edges, directed=exact)
    return items.select("item_id", "ord", "digest_key").join(labels, "ord") \
        .withColumnRenamed("label", "leader_ord")
