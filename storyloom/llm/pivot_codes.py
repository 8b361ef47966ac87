"""Compression of vectors to part codes, fitted by integer k-means with LAESA pivots (operator 11).

A component x becomes the integer ``floor(4096 x)``. Vectors are cut into ``parts`` equal parts and each part
position has a codebook of ``entries`` entries: the parts of the smallest ids at first, then ``rounds`` times the
floor of the mean of the parts that are assigned to an entry. Everything that decides is an integer, so results
do not depend on how the rows are dealt out.

*LAESA.* A few fixed pivots for each part position (entries of the first codebook, far apart from one
another) are measured against all parts once; the distances are stored with the rows. In each round only the
distances from pivots to entries are new, ``parts x pivots x entries`` of them. The differences
``|d(part, pivot) - d(pivot, entry)|`` are lower bounds of ``d(part, entry)`` by the triangle
inequality: entries are tried in the order of their bounds, and a part is done when the next bound is larger
than its best distance. Distances of the entries tried are exact integers; a tie goes to the lower index,
so an entry is left out only if its bound is larger than the best distance by more than rounding can explain.

A round is one pass over the stored rows; a task sends the sums of ``parts x entries`` entries, which Spark adds up,
and the new codebooks (a size fixed by the parameters) come back to the driver. Nothing grows there.

Defined results: a vector that is null, empty or has null or non-finite components is dropped, as is one whose
length is no multiple of ``parts`` or not that of the smallest kept vec_id. Integers beyond ``limit`` (2^27 for up to
64 components) are cut to it, so that squared distances fit in 64 bits. Ids: null is the largest, rows
of one id follow the order of their vectors; repeated rows give a row each. Fewer rows than entries make a smaller
codebook. ``label_error`` is null where it does not fit in 64 bits. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.arrow import column, give_back
from storyloom.operators.materialize import materialize

#: Fixed pivots of a part position.
PIVOTS = 4
#: Rows worked on at once in a task.
STEP = 4096
#: Labels up to this number go to every executor with their sums (24 bytes each); more are joined by shuffle.
BROADCAST_LABELS = 200_000


def limit(dim: int) -> int:
    """The largest integer whose squared distances over ``dim`` components fit in 63 bits."""
    return 1 << ((62 - max(dim - 1, 0).bit_length()) // 2 - 1)


def choose_pivots(book: np.ndarray, most: int) -> np.ndarray:
    """Entries of a codebook ``(entries, width)``, each the farthest from those before."""
    chosen = [0]
    near = np.full(len(book), np.inf)
    while len(chosen) < min(most, len(book)):
        near = np.minimum(near, ((book - book[chosen[-1]]).astype(float) ** 2).sum(axis=1))
        if not near.max() > 0:
            break
        chosen.append(int(near.argmax()))
    return book[chosen]


def nearest_entry(x: np.ndarray, to_pivot: np.ndarray, pivots: np.ndarray, book: np.ndarray):
    """Index and squared distance of the nearest entry of each part, and how many distances were computed.
    ``x`` (rows, width) and ``book`` (entries, width) are integers, ``to_pivot`` (rows, pivots) distances."""
    between = np.sqrt(((pivots[:, None, :] - book[None, :, :]).astype(float) ** 2).sum(axis=2))
    bound = np.abs(to_pivot[:, :1] - between[0][None, :])
    for p in range(1, len(pivots)):
        np.maximum(bound, np.abs(to_pivot[:, p:p + 1] - between[p][None, :]), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, axis=1)
    best = np.full(len(x), np.iinfo(np.int64).max)
    which = np.full(len(x), len(book))
    # what rounding can add to a bound: distances are sums of squares below 2^63
    room = 1e-9 * (1 + to_pivot.max(axis=1, initial=0.0) + between.max(initial=0.0))
    open_, computed = np.arange(len(x)), 0
    for k in range(len(book)):
        if k:
            open_ = open_[bound[open_, k] <= np.sqrt(best[open_].astype(float)) + room[open_]]
        if not len(open_):
            break
        e = order[open_, k]
        d = ((x[open_] - book[e]) ** 2).sum(axis=1)
        computed += len(open_)
        take = (d < best[open_]) | ((d == best[open_]) & (e < which[open_]))
        best[open_[take]], which[open_[take]] = d[take], e[take]
    return which, best, computed


def _grid(batch: pa.RecordBatch, name: str, shape: tuple, kind) -> np.ndarray:
    return np.asarray(column(batch, name).flatten(), dtype=kind).reshape(-1, *shape)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, STEP):
            yield batch.slice(a, STEP)


def _measure(shared, parts: int, dim: int):
    """The rows with their integers and their parts' distances to the pivots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for batch in _steps(batches):
            x = _integers(_grid(batch, "v", (dim,), float))
            own = x.reshape(-1, parts, dim // parts)
            far = [np.sqrt(((own[:, p, None, :] - pivots[p][None]).astype(float) ** 2).sum(axis=2)) for p in range(parts)]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "vec_id"), column(batch, "label"), _lists(x), _lists(np.concatenate(far, axis=1))],
                ["vec_id", "label", "x", "far"])
        give_back()
    return run


def _lists(a: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1]), pa.array(a.ravel()))


def _integers(v: np.ndarray) -> np.ndarray:
    most = limit(v.shape[1])
    return np.floor(np.clip(v * 4096, -most, most)).astype(np.int64)


def _assigned(batch: pa.RecordBatch, own: dict):
    """For each part position the parts, their entries and squared distances."""
    parts, width = own["parts"], own["dim"] // own["parts"]
    x = _grid(batch, "x", (parts, width), np.int64)
    far = _grid(batch, "far", (sum(map(len, own["pivots"])),), float)
    at = 0
    for p in range(parts):
        pivots = own["pivots"][p]
        which, best, _ = nearest_entry(x[:, p], far[:, at:at + len(pivots)], pivots, own["books"][p])
        at += len(pivots)
        yield p, x[:, p], which, best


def _sums(shared):
    """Of a task's rows: the number and the componentwise sums of each entry's parts, as decimal text
    where sums may not fit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        width = own["dim"] // own["parts"]
        most = len(own["books"][0])
        n = np.zeros((own["parts"], most), np.int64)
        total = np.zeros((own["parts"], most, width), object)
        for batch in _steps(batches):
            for p, x, which, _ in _assigned(batch, own):
                n[p] += np.bincount(which, minlength=most)
                for i in range(width):  # a step's sums fit: 4096 x 2^27
                    own_sum = np.zeros(most, np.int64)
                    np.add.at(own_sum, which, x[:, i])
                    total[p, :, i] += own_sum.astype(object)
        out = [(p, e, i, int(n[p, e]), str(total[p, e, i])) for p in range(own["parts"]) for e in range(most)
               if n[p, e] for i in range(width)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in out], t) for c, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string()))],
            ["part", "entry", "i", "n", "total"])
        give_back()
    return run


def _codes(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in _steps(batches):
            code = np.zeros((batch.num_rows, own["parts"]), np.uint8)
            error = np.zeros(batch.num_rows, np.int64)
            for p, _, which, best in _assigned(batch, own):
                code[:, p] = which
                error += best
            yield pa.RecordBatch.from_arrays(
                [column(batch, "vec_id"), column(batch, "label"), pa.array([c.tobytes().hex() for c in code], pa.string()),
                 pa.array(error)], ["vec_id", "label", "code", "error"])
        give_back()
    return run


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def fit(rows: DataFrame, books: np.ndarray, pivots: list[np.ndarray], rounds: int) -> np.ndarray:
    """The codebooks (parts, entries, width) after the rounds, from rows with integers ``x`` and distances ``far``."""
    sc = rows.sparkSession.sparkContext
    parts, _, width = books.shape
    for _ in range(rounds):
        own = sc.broadcast({"parts": parts, "dim": parts * width, "pivots": pivots, "books": books})
        sums = (rows.mapInArrow(_sums(own), "part int, entry int, i int, n long, total string")
                .groupBy("part", "entry", "i")
                .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")))
        books = books.copy()
        for r in sums.collect():  # parts x entries x width rows
            books[r["part"], r["entry"], r["i"]] = int(r["total"]) // r["n"]
        own.unpersist()
    return books


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of each kept row of
    ``vectors(vec_id, embedding, label)``."""
    if entries > 256:
        raise ValueError("an entry's index is written as two hex digits")
    spark = vectors.sparkSession
    v = F.col("v")
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").alias("v")) \
        .where(F.coalesce((F.size(v) > 0) & (F.size(v) % parts == 0)
                          & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)))
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(1).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    dim = len(first[0]["v"])
    kept = kept.where(F.size("v") == dim)
    start = kept.orderBy(F.asc_nulls_last("vec_id"), "v").select("v").limit(entries).collect()
    books = _integers(np.array([r["v"] for r in start], float)).reshape(len(start), parts, dim // parts).transpose(1, 0, 2).copy()
    pivots = [choose_pivots(b, PIVOTS) for b in books]
    sc = spark.sparkContext
    rows = materialize(kept.mapInArrow(_measure(sc.broadcast(pivots), parts, dim),
                                       "vec_id long, label long, x array<bigint>, far array<double>"), "vector-parts")
    books = fit(rows, books, pivots, rounds)
    own = sc.broadcast({"parts": parts, "dim": dim, "pivots": pivots, "books": books})
    coded = materialize(rows.mapInArrow(_codes(own), "vec_id long, label long, code string, error long"), "vector-codes")
    sums = materialize(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("sum"))
                       .select(F.col("label").alias("of"), F.expr("try_cast(sum as bigint)").alias("label_error")), "label-errors")
    if sums.count() <= BROADCAST_LABELS:
        got = coded.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of")))
    else:  # a common label's rows are dealt over salts
        salts = 32
        left = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)).cast("int"))
        right = sums.withColumn("salt_of", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        got = left.join(right, (F.col("salt") == F.col("salt_of")) & F.col("label").eqNullSafe(F.col("of")))
    return got.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
