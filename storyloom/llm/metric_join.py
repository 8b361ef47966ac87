"""Links between near-equal vectors by an exact metric range join (operator 13).

Vectors of unit length with cosine ``t`` lie ``sqrt(2 - 2t)`` apart, so the links are the pairs within that
radius ``r``. *Pivots*, far apart from one another, are taken from a bounded sample; every vector has its
home in the cell of its nearest pivot. For each cell the least and largest distance of its members to
every pivot are aggregated. By the triangle inequality a vector ``x`` can be within ``r`` of a member of
cell ``c`` only if, for every pivot ``q``, ``low(c, q) - r <= d(x, q) <= high(c, q) + r``, and only if
``d(x, c) <= d(x, home) + 2r``. Where both hold, ``x`` is copied into ``c`` as a guest. A pair of two
cells meets in the lower one, so only guests from higher cells are sent.

*Cells join on their own*: the members of a cell are dealt into home blocks and its members and guests into
guest blocks, both of bounded size, and each pair of blocks is one group. So a cell may hold any share of the
rows. In a group, rows in order of their distance to the pivot meet only those within ``r`` of that distance;
cosines are computed in double precision. A group returns for each vector the number of its links and the
edges of a spanning forest of what it has joined, never pairs, and components are taken over these edges.

Equal vectors are one class with a count from the start: copies cost one row. On vectors without structure
(64 independent dimensions) the bounds prune little: nearly every vector is a guest of nearly every cell and the
work grows with the square of the distinct vectors, as for any exact method known; on clustered vectors a
cell gets its neighbourhood only.

Defined results: a vector that is null, empty, zero or has null or non-finite components has no links and is its
own component. Vectors of different lengths are never linked; those of other lengths than the commonest in the sample
form a cell by length. Rows that repeat a vector (with the same vec_id or not) link with one another, and each
row gives a row. A null vec_id takes part; a component's id is its least vec_id that is not null (null if
there is none), and such a row is not kept. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.arrow import column, give_back, mixed
from storyloom.llm.components import components
from storyloom.operators.materialize import materialize

#: Rows of a home block and of a guest block: what a group holds at most, on average.
HOME_ROWS, GUEST_ROWS = 2048, 8192
#: Most cells; above ``CELLS * HOME_ROWS`` distinct vectors the blocks of a cell grow in number.
CELLS = 128
#: Vectors that pivots are chosen from.
SAMPLE = 4096
#: Distances from rounded cosines are this exact; bounds are widened by it.
SLACK = 1e-6
#: Rows multiplied at once.
STEP = 256


def usable(v):
    """A vector column that can be compared: not null, no null or non-finite component, not zero."""
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """The vectors of a batch at unit length."""
    x = np.asarray(column(batch, "v").flatten(), dtype=np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=1e-300)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _apart(cos: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cos, 0))


def choose_pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` vectors, each the farthest from those chosen before."""
    chosen, near = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(most, len(sample)):
        near = np.minimum(near, _apart(sample @ sample[chosen[-1]]))
        far = int(near.argmax())
        if near[far] <= SLACK:
            break
        chosen.append(far)
    return sample[chosen]


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def _envelopes(shared):
    """Of a task's rows: for each cell and pivot the number, least and largest distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value["pivots"]
        k = len(p)
        low, high, n = np.full((k, k), np.inf), np.full((k, k), -np.inf), np.zeros(k, np.int64)
        for batch in _parts(batches):
            d = _apart(_matrix(batch, p.shape[1]) @ p.T)
            home = d.argmin(axis=1)
            np.minimum.at(low, home, d)
            np.maximum.at(high, home, d)
            n += np.bincount(home, minlength=k)
        cell, q = (x.ravel() for x in np.indices((k, k)))
        have = n[cell] > 0
        yield pa.RecordBatch.from_arrays([pa.array(cell[have]), pa.array(q[have]), pa.array(n[cell[have]]),
                                          pa.array(low.ravel()[have]), pa.array(high.ravel()[have])],
                                         ["cell", "pivot", "n", "low", "high"])
        give_back()
    return run


def _reach(d: np.ndarray, own: dict) -> Iterator[tuple[int, np.ndarray]]:
    """Each cell with the rows (by their distances to all pivots) that are members or guests of it."""
    home, r = d.argmin(axis=1), own["radius"] + SLACK
    at_home = d[np.arange(len(d)), home]
    for c in range(d.shape[1]):
        ok = (home >= c) & (d[:, c] <= at_home + 2 * r)
        rows = np.flatnonzero(ok)
        inside = ((d[rows] >= own["low"][c] - r) & (d[rows] <= own["high"][c] + r)).all(axis=1)
        yield c, rows[inside | (home[rows] == c)]


def _count_guests(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        n = np.zeros(len(own["pivots"]), np.int64)
        for batch in _parts(batches):
            for c, rows in _reach(_apart(_matrix(batch, own["pivots"].shape[1]) @ own["pivots"].T), own):
                n[c] += len(rows)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n))), pa.array(n)], ["cell", "guests"])
        give_back()
    return run


def _copies(batch: pa.RecordBatch, cell: int, d: np.ndarray, home: np.ndarray, homes: int, guests: int):
    """A batch's rows as members of home blocks (if at home) and of guest blocks of a cell, for every
    pair of blocks that they take part in."""
    cls = np.asarray(column(batch, "cls"), np.int64)
    h = mixed(cls.astype(np.uint64))
    block_a = (h % np.uint64(homes)).astype(np.int64)
    block_b = ((h >> np.uint64(32)) % np.uint64(guests)).astype(np.int64)

    def rows(at, a, b, guest):
        out = batch.take(pa.array(at))
        n = len(at)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, cell)), pa.array(a), pa.array(b), pa.array(np.full(n, guest)),
             pa.array(home[at]), pa.array(d[at]), column(out, "cls"), column(out, "n"), column(out, "v")],
            ["cell", "a", "b", "guest", "own", "d", "cls", "n", "v"])
    every, own = np.arange(len(cls)), np.flatnonzero(home)
    for a in range(homes):
        yield rows(every, np.full(len(every), a), block_b, True)
    if len(own):
        for b in range(guests):
            yield rows(own, block_a[own], np.full(len(own), b), False)


def _route(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in _parts(batches):
            d = _apart(_matrix(batch, own["pivots"].shape[1]) @ own["pivots"].T)
            home = d.argmin(axis=1)
            for c, rows in _reach(d, own):
                if len(rows) and own["homes"][c]:
                    yield from _copies(batch.take(pa.array(rows)), c, d[rows, c], home[rows] == c,
                                       -(-own["homes"][c] // own["home_rows"]), -(-own["guests"][c] // own["guest_rows"]))
        give_back()
    return run


def _root(parent: np.ndarray, i: np.ndarray) -> np.ndarray:
    up = parent[i]
    while True:
        over = parent[up]
        if (over == up).all():
            return up
        up = over


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of each pair (a, b); a root's parent is the smallest root it has met."""
    while True:
        a, b = _root(parent, a), _root(parent, b)
        open_ = a != b
        if not open_.any():
            return
        a, b = a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def _join(threshold: float):
    """The links of a group: counts of each class and a spanning forest."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        batch = rows.to_batches()[0]
        dim = len(batch.column(batch.schema.get_field_index("v"))[0])
        z, guest = _matrix(batch, dim), np.asarray(column(batch, "guest"))
        d, n = np.asarray(column(batch, "d")), np.asarray(column(batch, "n"), float)
        names, node = np.unique(np.asarray(column(batch, "cls"), np.int64), return_inverse=True)
        left, right = np.flatnonzero(~guest), np.flatnonzero(guest)
        left, right = left[np.argsort(d[left], kind="stable")], right[np.argsort(d[right], kind="stable")]
        same = np.asarray(column(batch, "own"))[right]
        r = np.sqrt(2 - 2 * threshold) + SLACK
        links, parent = np.zeros(len(names)), np.arange(len(names))
        for a in range(0, len(left), STEP):
            x = left[a:a + STEP]
            lo, hi = np.searchsorted(d[right], (d[x[0]] - r, d[x[-1]] + r))
            for b in range(lo, hi, GUEST_ROWS):
                y = right[b:min(b + GUEST_ROWS, hi)]
                cos = z[x] @ z[y].T
                hit = cos >= threshold
                # products of blocks may be rounded otherwise than a sum of products
                i, j = np.nonzero(np.abs(cos - threshold) < 1e-12)
                if len(i):
                    hit[i, j] = (z[x[i]] * z[y[j]]).sum(axis=1) >= threshold
                # two members of the cell are both home and guest: their pair counts once
                hit &= ~same[None, b:b + len(y)] | (node[x][:, None] < node[y][None, :])
                if not hit.any():
                    continue
                w = hit.astype(float)
                np.add.at(links, node[x], w @ n[y])
                np.add.at(links, node[y], n[x] @ w)
                some = np.flatnonzero(hit.any(axis=1))
                _unite(parent, node[x[some]], node[y[hit[some].argmax(axis=1)]])
                some = np.flatnonzero(hit.any(axis=0))
                _unite(parent, node[x[hit[:, some].argmax(axis=0)]], node[y[some]])
                i, j = np.nonzero(hit & (_root(parent, node[x])[:, None] != _root(parent, node[y])[None, :]))
                if len(i):
                    _unite(parent, node[x[i]], node[y[j]])
        some = np.flatnonzero(links)
        return pa.table({"cls": names[some], "links": links[some].astype(np.int64),
                         "root": names[_root(parent, some)]})
    return run


def links_and_components(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of each row of ``vectors(vec_id, embedding)``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    good = usable(F.col("v"))
    kind = rows.schema["v"].dataType.simpleString()
    # two 64-bit hashes name a vector
    names = [F.when(good, F.xxhash64(F.lit(s), F.col("v"))).alias(f"h{s}") for s in (1, 2)]
    keyed = rows.select("vec_id", "v", *names)
    classes = materialize(
        keyed.where("h1 is not null").groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("n"), F.first("v").alias("v"))
        .withColumn("cls", F.monotonically_increasing_id()).withColumn("dim", F.size("v")), "vector-classes")
    work = _work(classes, kind, threshold)
    found = None
    if work is not None:
        found = materialize(work.groupBy("cell", "a", "b").applyInArrow(_join(threshold), "cls long, links long, root long"),
                            "vector-links")
    if found is None:
        found = spark.createDataFrame([], "cls long, links long, root long")
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    label = components(found.select(F.col("root").alias("a"), F.col("cls").alias("b")))
    of_class = (classes.select("h1", "h2", "first_id", "n", "cls").join(counts, "cls", "left")
                .join(label.withColumnRenamed("node", "cls"), "cls", "left")
                .withColumn("label", F.coalesce("label", "cls")))
    least = of_class.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_class = of_class.join(least, "label").select(
        "h1", "h2", (F.coalesce("links", F.lit(0).cast("long")) + F.col("n") - 1).alias("n_links"), "component_id")
    got = keyed.select("vec_id", "h1", "h2").join(of_class, ["h1", "h2"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return got.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def _work(classes: DataFrame, kind: str, threshold: float) -> DataFrame | None:
    """The rows of every group: (cell, a, b), whether guest, whether the cell is home, distance, class, vector."""
    spark = classes.sparkSession
    number = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}
    if not number:
        return None
    dim = max(number, key=lambda k: (number[k], -k))
    main = classes.where(F.col("dim") == dim).select("cls", "n", "v")
    sample = main.orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE).select("v").toArrow().to_batches()
    sample = np.concatenate([_matrix(b, dim) for b in sample])
    pivots = choose_pivots(sample, min(CELLS, -(-number[dim] // HOME_ROWS)))
    k, own = len(pivots), {"pivots": pivots, "radius": float(np.sqrt(2 - 2 * threshold)),
                           "home_rows": HOME_ROWS, "guest_rows": GUEST_ROWS}
    sc = spark.sparkContext
    env = (main.mapInArrow(_envelopes(sc.broadcast(own)), "cell long, pivot long, n long, low double, high double")
           .groupBy("cell", "pivot").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")))
    own |= {"low": np.full((k, k), np.inf), "high": np.full((k, k), -np.inf), "homes": np.zeros(k, np.int64)}
    for e in env.collect():  # cells x pivots rows
        own["low"][e["cell"], e["pivot"]], own["high"][e["cell"], e["pivot"]] = e["low"], e["high"]
        own["homes"][e["cell"]] = e["n"]
    own["guests"] = np.zeros(k, np.int64)
    for g in main.mapInArrow(_count_guests(sc.broadcast(own)), "cell long, guests long") \
            .groupBy("cell").agg(F.sum("guests").alias("guests")).collect():
        own["guests"][g["cell"]] = g["guests"]
    schema = f"cell long, a long, b long, guest boolean, own boolean, d double, cls long, n long, v {kind}"
    work = main.mapInArrow(_route(sc.broadcast(own)), schema)
    for other, n in sorted(number.items()):
        if other != dim:  # a cell of its own, without a pivot
            rest = classes.where(F.col("dim") == other)
            homes, guests = -(-n // HOME_ROWS), -(-n // GUEST_ROWS)
            a, b = (F.pmod(F.xxhash64(F.lit(s), "cls"), F.lit(m)).cast("long") for s, m in ((1, homes), (2, guests)))
            every = [F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))) for m in (homes, guests)]
            cols = [F.lit(-other).cast("long").alias("cell")], [F.lit(True).alias("own"), F.lit(0.0).alias("d"), "cls", "n", "v"]
            work = work.unionByName(rest.select(*cols[0], every[0].alias("a"), b.alias("b"), F.lit(True).alias("guest"), *cols[1])) \
                .unionByName(rest.select(*cols[0], a.alias("a"), every[1].alias("b"), F.lit(False).alias("guest"), *cols[1]))
    return work
