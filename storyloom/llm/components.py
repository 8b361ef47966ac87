"""Connected components of a table of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.operators.materialize import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to its smallest one (or to itself)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m"))
    low = low.select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest one.
    Edges come with a < b."""
    low = edges.groupBy("b").agg(F.min("a").alias("m"))
    own = low.select(F.col("m").alias("a"), "b")
    rest = edges.join(low, "b").where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return own.unionByName(rest).distinct()


def _shape(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node that occurs in ``links(a, b)``: label is the smallest
    node that links reach. Nodes are longs. Self links and repeated links are allowed; null
    ends are ignored. Each round is written to the shared folder; the loop ends at the fixed
    point, whatever the number of rounds. Minima combine before the shuffle, so a node with
    very many links costs no more than its rows."""
    edges = materialize(links.where("a <> b").select(F.least("a", "b").alias("a"),
                                                     F.greatest("a", "b").alias("b")).distinct(),
                        "links")
    was = _shape(edges)
    while was[0]:
        edges = materialize(_small_star(_large_star(edges)), "stars")
        now = _shape(edges)
        if now == was:
            break
        was = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())
