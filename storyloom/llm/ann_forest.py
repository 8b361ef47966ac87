"""Approximate nearest neighbours by a forest of random-projection trees (operator 4).

*Trees.* Each inner node splits by the hyperplane between two random sample vectors, at the median of the
sample's projections. The trees are fitted on a bounded sample (``SAMPLE`` vectors, chosen by a hash of their
id) and are a fixed size; every row is indexed: it descends each tree to one leaf.

*Search.* A query keeps one priority queue for all trees. A branch's priority is the sum of the squared
distances to the hyperplanes that lie between it and the query; leaves are taken, nearest first, until they
hold ``visit`` times as many rows as there are vectors (a row counts in each tree), and enough for k
answers, however the rows repeat ids. The sizes of leaves are known by then, so the queue ends by rows read, not by leaves.

*Reranking.* The leaves' rows are scored exactly (inner products in double precision on the original vectors).
Queries and rows meet by (tree, leaf, block): a leaf of many rows is dealt into blocks of about ``BLOCK_ROWS``,
and the queries too, so no task holds more than a block of either, and all copies of one vector in one leaf
are no special case. A block returns each query's nearest k ids only; the blocks' answers are merged per query.

How much must be visited is a property of the data: the given vectors have 64 dimensions of about equal
weight, and a recall of 0.9 needs a large part of them (see the README). ``visit`` is a parameter.

Defined results: vectors that are null, zero, hold null or non-finite components, or whose length is not the
sample's most frequent one take no part, nor do rows with a null id. Rows that repeat an id are one
candidate (the nearest of them; rows that repeat an id and vector are one row before they are indexed); equal scores go to the smaller id. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storyloom.llm.arrow import column
from storyloom.operators.materialize import materialize

TREES = 3
DEPTH = 6
SAMPLE = 20_000
VISIT = 1.1
BLOCK_ROWS = 16_384


class Forest:
    def __init__(self, x: np.ndarray, trees: int, depth: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        inner = (1 << depth) - 1
        self.depth = depth
        self.normals = np.zeros((trees, inner, x.shape[1]))
        self.cuts = np.zeros((trees, inner))
        for t in range(trees):
            rows = {0: np.arange(len(x))}
            for k in range(inner):
                own = rows.pop(k)
                w = np.zeros(x.shape[1])
                if len(own) > 1:
                    a, b = rng.choice(own, 2, replace=False)
                    w = x[a] - x[b]
                if not w.any():
                    w = rng.standard_normal(x.shape[1])
                w /= np.linalg.norm(w)
                p = x[own] @ w
                cut = float(np.median(p)) if len(own) else 0.0
                self.normals[t, k], self.cuts[t, k] = w, cut
                rows[2 * k + 1], rows[2 * k + 2] = own[p <= cut], own[p > cut]

    def leaves(self, x: np.ndarray, tree: int) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            side = np.einsum("ij,ij->i", x, self.normals[tree, at]) > self.cuts[tree, at]
            at = 2 * at + 1 + side
        return at - ((1 << self.depth) - 1)

    def search(self, x: np.ndarray, sizes: np.ndarray, enough: float) -> list[tuple[int, int]]:
        """(tree, leaf) nearest first, until they hold ``enough`` rows. ``sizes``: trees x leaves."""
        inner = (1 << self.depth) - 1
        margin = self.normals @ x - self.cuts
        queue = [(0.0, t, 0) for t in range(len(margin))]
        out, held = [], 0
        while queue and held < enough:
            far, t, k = heapq.heappop(queue)
            if k >= inner:
                if sizes[t, k - inner]:
                    out.append((t, k - inner))
                    held += int(sizes[t, k - inner])
                continue
            m = float(margin[t, k])
            heapq.heappush(queue, (far + max(0.0, m) ** 2, t, 2 * k + 1))
            heapq.heappush(queue, (far + max(0.0, -m) ** 2, t, 2 * k + 2))
        return out


def valid(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v)`` of the rows that take part."""
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")) \
        .where("vec_id is not null and v is not null and size(v) > 0") \
        .where("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
               "and exists(v, x -> x <> 0)")


def _matrix(batch: pa.RecordBatch | pa.Table, name: str, dim: int) -> np.ndarray:
    flat = batch.column(name)
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(-1, dim)


def _index(shared, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch, "v", dim)
            for t in range(len(forest.cuts)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(forest.leaves(x, t).astype(np.int32)),
                     column(batch, "vec_id"), column(batch, "v")], ["tree", "leaf", "vec_id", "v"])
    return run


def _probe(shared, dim: int, sizes: np.ndarray, enough: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [forest.search(x, sizes, enough) for x in _matrix(batch, "v", dim)]
            row = np.repeat(np.arange(len(found)), [len(f) for f in found])
            flat = np.array([p for f in found for p in f], np.int32).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[:, 0]), pa.array(flat[:, 1]), column(batch, "vec_id").take(pa.array(row)),
                 column(batch, "v").take(pa.array(row))], ["tree", "leaf", "query_id", "q"])
    return run


def _rerank(dim: int, k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        if left.num_rows and right.num_rows:
            q, v = _matrix(left, "q", dim), _matrix(right, "v", dim)
            qid, vid = np.asarray(left.column("query_id")), np.asarray(right.column("vec_id"))
            order = np.argsort(vid, kind="stable")
            v, vid = v[order], vid[order]
            first = np.flatnonzero(np.r_[True, vid[1:] != vid[:-1]])  # of the rows of each candidate
            for a in range(0, len(q), 512):
                s = q[a:a + 512] @ v.T
                s[qid[a:a + 512, None] == vid[None]] = -np.inf
                if len(first) > k:
                    best = np.maximum.reduceat(s, first, axis=1) if len(first) < len(vid) else s
                    kth = np.partition(best, len(first) - k, axis=1)[:, len(first) - k]
                else:
                    kth = np.full(len(s), -np.inf)
                # a little below the k-th, as products of equal vectors may round differently
                r, c = np.nonzero((s >= (kth - 1e-9 * (1 + np.abs(kth)))[:, None]) & (s > -np.inf)
                                  if np.isfinite(kth).all() else s > -np.inf)
                exact = (q[a + r] * v[c]).sum(axis=1)
                order = np.lexsort((vid[c], -exact, r))
                r, c, exact = r[order], c[order], exact[order]
                if len(first) < len(vid):  # the nearest row of each candidate
                    _, one = np.unique(r * len(vid) + np.searchsorted(vid, vid[c]), return_index=True)
                    one.sort()
                    r, c, exact = r[one], c[one], exact[one]
                rank = np.arange(len(r)) - np.searchsorted(r, r)
                keep = rank < k
                out_q.append(qid[a + r[keep]])
                out_v.append(vid[c[keep]])
                out_s.append(exact[keep])
        return pa.table({"query_id": pa.array(np.concatenate(out_q)), "vec_id": pa.array(np.concatenate(out_v)),
                         "score": pa.array(np.concatenate(out_s))})
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, visit: float = VISIT, trees: int = TREES,
            depth: int = DEPTH) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest found of each query (largest inner product).
    Both inputs have vec_id and embedding; a query is no candidate of its own."""
    spark = vectors.sparkSession
    rows, asked = materialize(valid(vectors).distinct(), "vectors"), valid(queries).distinct()
    n = rows.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not n:
        return empty
    part = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(part < SAMPLE / n).select("v").limit(2 * SAMPLE).toArrow().column("v").to_pylist()
    if not sample:
        sample = [r["v"] for r in rows.select("v").limit(SAMPLE).collect()]
    dim = Counter(map(len, sample)).most_common(1)[0][0]
    forest = Forest(np.array([v for v in sample if len(v) == dim], float), trees, depth)
    shared = spark.sparkContext.broadcast(forest)
    rows, asked = rows.where(F.size("v") == dim), asked.where(F.size("v") == dim)
    kind = rows.schema["v"].dataType.simpleString()

    index = materialize(rows.mapInArrow(_index(shared, dim), f"tree int, leaf int, vec_id long, v {kind}"), "index")
    count = {(r["tree"], r["leaf"]): r["count"] for r in index.groupBy("tree", "leaf").count().collect()}
    sizes = np.zeros((trees, 1 << depth), np.int64)
    for at, c in count.items():
        sizes[at] = c
    repeats = rows.groupBy("vec_id").count().agg(F.max("count")).first()[0] or 1
    probes = materialize(asked.mapInArrow(_probe(shared, dim, sizes, max(visit * n, trees * repeats * (k + 1))),
                                          f"tree int, leaf int, query_id long, q {kind}"), "probes")
    n_asked = asked.count()
    sides = max(1, -(-n_asked // BLOCK_ROWS))
    blocks = [(t, leaf, -(-c // BLOCK_ROWS)) for (t, leaf), c in sorted(count.items())]  # trees x 2**depth rows
    of_leaf = [F.broadcast(spark.createDataFrame(blocks, "tree int, leaf int, blocks long")) for _ in range(2)]
    left = (probes.join(of_leaf[0], ["tree", "leaf"])
            .withColumn("side", F.pmod(F.xxhash64("query_id"), F.lit(sides)))
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .groupBy("tree", "leaf", "block", "side"))
    right = (index.join(of_leaf[1], ["tree", "leaf"])
             .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
             .withColumn("side", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(sides - 1).cast("long"))))
             .groupBy("tree", "leaf", "block", "side"))
    scored = left.cogroup(right).applyInArrow(_rerank(dim, k), "query_id long, vec_id long, score double")
    best = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
