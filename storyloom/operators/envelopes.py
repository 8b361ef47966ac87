"""Blocks of title keys of similar content, and bounds between them.

Two keys of lengths ``|a|`` and ``|b|`` with matching characters M have a ratio of ``2M / (|a| + |b|)``, and M is at
most the overlap of their character multisets, so the characters that differ, ``sum |a_c - b_c|``, are at
most ``(1 - t)(|a| + |b|)`` where the ratio exceeds ``t``. A *tree* of cuts by character counts and length, built from a
bounded sample, deals keys into leaves whose members have similar counts. The *envelope* of a leaf is the least and
largest count of each character among all its keys. Two leaves meet only if the gaps
between their envelopes, and their lengths, leave room for the ratio; and a key is sent to a
leaf that its own meets only if the gap between the key and that envelope does. Both tests are lossless.

Characters are counted in ``BUCKETS`` buckets: the commonest of the sample have one each, the rest share the others by
code; sharing only lowers a gap. The tree has at most ``LEAVES`` leaves whatever the number of
keys; larger leaves are dealt into blocks by hash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS, SHARED = 64, 16
#: Keys that the tree is built from, keys of a leaf to aim at, most leaves.
SAMPLE, LEAF_KEYS, LEAVES = 8192, 512, 4096


class Tree:
    """Cuts ``column <= threshold`` over character counts and length (the last column)."""

    def __init__(self, sample: list[str], leaves: int):
        common = Counter()
        for k in sample:
            common.update(k)
        self.codes = np.array(sorted(ord(c) for c, _ in common.most_common(BUCKETS - SHARED)), np.int64)
        self.column: list[int] = []
        self.threshold: list[int] = []
        self.below: list[tuple[int, int]] = []  # a leaf is minus its number, less one
        self.leaves = 0
        self._cut(self.features(sample), leaves)

    def features(self, keys: list[str]) -> np.ndarray:
        """(keys x (BUCKETS + 1)) counts and lengths."""
        length = np.fromiter(map(len, keys), np.int64, len(keys))
        code = np.frombuffer("".join(keys).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        at = np.searchsorted(self.codes, code)
        own = np.minimum(at, max(len(self.codes) - 1, 0))
        known = self.codes[own] == code if len(self.codes) else np.zeros(len(code), bool)
        bucket = np.where(known, own, BUCKETS - SHARED + code % SHARED)
        of = np.repeat(np.arange(len(keys)), length) * BUCKETS + bucket
        counts = np.bincount(of, minlength=len(keys) * BUCKETS).reshape(len(keys), BUCKETS)
        return np.column_stack((counts, length))

    def _cut(self, x: np.ndarray, leaves: int) -> int:
        if leaves > 1 and len(x) > 1:
            for c in np.argsort(-x.std(axis=0), kind="stable").tolist():
                t = int(np.median(x[:, c]))
                low = x[:, c] <= t
                if not low.all() and low.any():
                    me = len(self.column)
                    self.column.append(c)
                    self.threshold.append(t)
                    self.below.append((0, 0))
                    few = max(1, round(leaves * float(low.mean())))
                    self.below[me] = self._cut(x[low], few), self._cut(x[~low], max(1, leaves - few))
                    return me
        self.leaves += 1
        return -self.leaves

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of features."""
        if not self.column:
            return np.zeros(len(x), np.int64)
        column, threshold, below = np.array(self.column), np.array(self.threshold), np.array(self.below)
        at, row = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(row):
            node = at[row]
            at[row] = below[node, (x[row, column[node]] > threshold[node]).astype(int)]
            row = row[at[row] >= 0]
        return -at - 1


def build_tree(keys: DataFrame, number: int) -> Tree:
    sample = keys.orderBy(F.xxhash64("key"), "key").select("key").limit(SAMPLE).collect()
    return Tree([r["key"] for r in sample], min(LEAVES, -(-number // LEAF_KEYS)))


def _list(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]),
                                    pa.array(np.ascontiguousarray(x, np.int32).ravel()))


def placed(keys: DataFrame, tree) -> DataFrame:
    """``(digest_key, key, kid, klen, leaf, counts)`` of each key; ``tree``: a broadcast."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                x = tree.value.features(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(x[:, -1]), pa.array(tree.value.leaf(x)), _list(x[:, :-1])],
                    ["digest_key", "key", "kid", "klen", "leaf", "counts"])
    return keys.select("digest_key", "key", "kid").mapInArrow(run, "digest_key string, key string, kid long, klen long, leaf long, counts array<int>")


def envelopes(keys: DataFrame) -> DataFrame:
    """``(digest_key, leaf, n, low, high, shortest, longest)`` of ``placed`` keys; tasks send one row a leaf."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict = {}
        for batch in batches:
            dk, leaf = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            x = np.asarray(batch.column(2).flatten(), np.int64).reshape(batch.num_rows, BUCKETS)
            length = np.asarray(batch.column(3), np.int64)
            places: dict = {}
            for i, k in enumerate(zip(dk, leaf)):
                places.setdefault(k, []).append(i)
            for k, at in places.items():
                new = [len(at), x[at].min(axis=0), x[at].max(axis=0), int(length[at].min()), int(length[at].max())]
                own[k] = _joined(own[k], new) if k in own else new
        yield _rows(own)

    def merged(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        out = None
        for r in rows.to_pylist():
            new = [r["n"], np.array(r["low"]), np.array(r["high"]), r["shortest"], r["longest"]]
            out = new if out is None else _joined(out, new)
        return pa.Table.from_batches([_rows({(key[0].as_py(), key[1].as_py()): out})])
    schema = "digest_key string, leaf long, n long, low array<int>, high array<int>, shortest long, longest long"
    return keys.select("digest_key", "leaf", "counts", "klen").mapInArrow(partial, schema) \
        .groupBy("digest_key", "leaf").applyInArrow(merged, schema)


def _joined(a: list, b: list) -> list:
    return [a[0] + b[0], np.minimum(a[1], b[1]), np.maximum(a[2], b[2]), min(a[3], b[3]), max(a[4], b[4])]


def _rows(own: dict) -> pa.RecordBatch:
    n, low, high, short, long = zip(*own.values()) if own else ((),) * 5
    grid = lambda x: _list(np.array(x).reshape(-1, BUCKETS))
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in own], pa.string()), pa.array([k[1] for k in own], pa.int64()), pa.array(n, pa.int64()),
         grid(low), grid(high), pa.array(short, pa.int64()), pa.array(long, pa.int64())],
        ["digest_key", "leaf", "n", "low", "high", "shortest", "longest"])


def can_reach(t: float, a: str, b: str) -> str:
    """SQL condition: a pair of envelopes (columns ``{a}low`` and so on) leaves room for a ratio above ``t``."""
    gap = (f"aggregate(zip_with(zip_with({a}low, {b}high, (x, y) -> x - y), zip_with({b}low, {a}high, (x, y) -> x - y), "
           "(x, y) -> greatest(x, y, 0)), 0, (s, x) -> s + x)")
    room = f"aggregate(zip_with({a}high, {b}high, (x, y) -> least(x, y)), 0, (s, x) -> s + x)"
    apart = (f"case when {a}longest < {b}shortest then 2.0D * {a}longest > {t}D * ({a}longest + {b}shortest) "
             f"when {b}longest < {a}shortest then 2.0D * {b}longest > {t}D * ({b}longest + {a}shortest) else true end")
    return (f"({apart}) and {gap} < (1.0D - {t}D) * ({a}longest + {b}longest) + 1e-6D "
            f"and 2.0D * {room} > {t}D * ({a}shortest + {b}shortest)")
