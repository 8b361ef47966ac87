"""N-gram Jaccard join (operator 1).

The documents and their n-grams (word shingles) form a sparse 0/1 incidence matrix A. The
similarity join is the masked product A·Aᵀ: entry (x, y) counts the shingles that x and y
share. It is never formed as a whole:

1. *Rows.* Documents with equal shingle sets are one class: exact copies and texts that differ
   in case or white space collapse before any pair is made.
2. *Columns.* Columns are ordered by document frequency, rare first. Frequencies come from a
   pass over all documents into a table of hashed counters of fixed size, so a very common
   n-gram is last in every row. Collisions change the order's quality, never the result.
3. *First block of columns.* Two sets of sizes m and n with Jaccard >= t share at least
   t/(1+t)·(m+n) n-grams, so they share one of the first ``n - ceil(t·n) + 1`` n-grams of each.
   Only these entries are shuffled, by n-gram; columns with a single class end here.
4. *Light columns* (``LIGHT`` members or fewer) are dealt into buckets of bounded size, and each is
   multiplied as a block of the matrix. A pair is discarded when sizes differ by more than t, or when
   the sizes inside 32 blocks of all columns leave no room: the overlap is at most the sum of the blocks'
   smaller sizes. The partial overlaps of the buckets are added up, and a pair is discarded when that and
   the most that its other columns can add stay below the bound. Survivors get their exact overlap
   from the whole texts, and links are contracted to components.
5. *Heavy columns*, star passes. In each column whose members lie in different components, the members
   are paired with one hub only, under the same bounds. A group of many near copies collapses here with
   pairs in proportion to its members. Passes go on while they find links and the product is more than
   twice the entries.
6. *Heavy columns*, product. What remains are pairs of different components. Classes are dealt into
   blocks of rows, blocks that share a column are multiplied with a table of counts, and bounds are
   applied before a pair leaves the task.

Nothing is sampled or capped: a pair of linked documents is either verified itself or already
inside one component by verified links.

Defined results: a null or empty text, or one without words, has no shingles, no links, and is
its own component. A text with fewer words than the width is one shingle. Rows that repeat give
a row each. Rows with a null id take part; their component is the smallest id that is not null,
else null. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.arrow import column, give_back, mixed, slices, text_column, word_hashes, words
from storyloom.llm.components import components
from storyloom.llm.storage import free_shuffles
from storyloom.operators.materialize import materialize

#: Counters of the frequency table (a fixed size: 4 MB whatever the input).
COUNTERS_LOG2 = 20
#: Rows that a task's counters are sent in.
COUNTER_SLICES = 64
#: Blocks of columns (by the hash's first bits) in which a set's sizes are kept for bounds.
BLOCKS_LOG2 = 5
#: Members up to which a column is light, and entries that one task multiplies.
LIGHT = 64
BUCKET_ENTRIES = 100_000
#: Rows of a block of the heavy columns' product.
BLOCK_ROWS = 1000
#: Ids that may be broadcast to pick texts from the documents; more are joined by a shuffle.
BROADCAST_IDS = 200_000


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    flat, begin = words(texts, lower=True)
    h = word_hashes(flat)
    grams = h.copy()
    for j in range(1, width):
        grams[:len(h) - j] = mixed(grams[:len(h) - j]) + h[j:]
    grams = mixed(grams)
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        if b - a >= width:
            yield np.unique(grams[a:b - width + 1])
        elif b > a:  # the whole sequence as one
            yield np.array([xxhash.xxh3_64_intdigest(h[a:b].tobytes(), seed=1)], np.uint64)
        else:
            yield np.empty(0, np.uint64)


def class_key(own: np.ndarray) -> int:
    """A signed 64-bit key of a shingle set and its size."""
    d = xxhash.xxh3_64_intdigest(own.tobytes(), seed=len(own))
    return d - (1 << 64) if d >> 63 else d


def _profile(width: int):
    """Of each document: set size and class. Of each task: its counters of all shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(1 << COUNTERS_LOG2, np.int64), False
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, keys, every, inside = [], [], [], []
                for own in shingle_sets(text_column(part, "text"), width):
                    sizes.append(len(own))
                    keys.append(class_key(own) if len(own) else None)
                    every.append(own)
                    inside.append(np.bincount((own >> np.uint64(64 - BLOCKS_LOG2)).astype(np.int64),
                                              minlength=1 << BLOCKS_LOG2))
                if every:
                    seen = True
                    bucket = np.concatenate(every) >> np.uint64(64 - COUNTERS_LOG2)
                    counts += np.bincount(bucket.astype(np.int64), minlength=len(counts))
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(keys, pa.int64()), pa.array(inside, pa.list_(pa.int32())),
                     pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                    ["doc_id", "n_shingles", "cls", "inside", "slice", "counts"])
        if seen:
            rows = np.split(np.minimum(counts, 0xFFFFFFFF).astype("<u4"), COUNTER_SLICES)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int64()),
                 pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.list_(pa.int32())),
                 pa.array(range(len(rows)), pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())],
                ["doc_id", "n_shingles", "cls", "inside", "slice", "counts"])
        give_back()
    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a task's slices, read as a stream: memory is that of the table, however many tasks sent counters."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, raw in zip(column(batch, "slice").to_pylist(), column(batch, "counts")):
            own = np.frombuffer(raw.as_py(), "<u4")
            if number in total:
                total[number] += own
            else:
                total[number] = own.astype(np.int64)
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()),
             pa.array([np.minimum(t, 0xFFFFFFFF).astype("<u4").tobytes() for t in total.values()], pa.binary())], ["slice", "counts"])
    give_back()


def frequencies(profile: DataFrame) -> np.ndarray:
    """The summed counters: always 2**COUNTERS_LOG2 numbers."""
    rows = (profile.where("slice is not null").select("slice", "counts").repartition(COUNTER_SLICES, "slice")
            .mapInArrow(_summed, "slice int, counts binary").collect())
    out = np.zeros(1 << COUNTERS_LOG2, "<u4")
    size = len(out) // COUNTER_SLICES
    for r in rows:
        out[r["slice"] * size:(r["slice"] + 1) * size] = np.frombuffer(r["counts"], "<u4")
    return out


def prefix_size(n, num: int, den: int):
    """How many first columns of a set of ``n`` any partner must meet (long or Column)."""
    return n - (n * num + den - 1) // den + 1


def _entries(width: int, num: int, den: int, table):
    """The first block's entries (token, cls) of each document's row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq = table.value
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, keys, sizes = [], [], []
                for own in shingle_sets(text_column(part, "text"), width):
                    if len(own):
                        p = prefix_size(len(own), num, den)
                        f = freq[own >> np.uint64(64 - COUNTERS_LOG2)]
                        tokens.append(own[np.lexsort((own, f))[:p]])
                        keys.append(class_key(own))
                        sizes.append(p)
                if tokens:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens).view(np.int64)),
                         pa.array(np.repeat(np.array(keys, np.int64), sizes))], ["token", "cls"])
        give_back()
    return run


def _texts(width: int):
    """Keep the rows whose text is that of the class (an id may have several texts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                own = [class_key(s) if len(s) else None
                       for s in shingle_sets(text_column(part, "text"), width)]
                same = [a == b for a, b in zip(own, column(part, "cls").to_pylist())]
                yield part.select(["cls", "text"]).filter(pa.array(same))
    return run


def _verify(width: int, num: int, den: int):
    """Exact overlap of each pair; a partner that many rows in a row share is read once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last = None, None
        for batch in batches:
            for part in slices(batch, "tb"):
                ka = np.asarray(column(part, "a"))
                new = np.flatnonzero(np.concatenate(([last_key != ka[0]], ka[1:] != ka[:-1])))
                left = shingle_sets(text_column(part, "ta").take(pa.array(new)), width)
                starts, keep = set(new.tolist()), []
                for i, other in enumerate(shingle_sets(text_column(part, "tb"), width)):
                    if i in starts:
                        last_key, last = ka[i], next(left)
                    both = len(np.intersect1d(last, other, assume_unique=True))
                    keep.append(den * both >= num * (len(last) + len(other) - both))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        give_back()
    return run


def _links(pairs: DataFrame, texts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose exact similarity reaches num/den."""
    left = texts.select(F.col("cls").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("cls").alias("b"), F.col("text").alias("tb"))
    full = pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
    return full.mapInArrow(_verify(width, num, den), "a long, b long")


def _sizes_fit(x: str, y: str, num: int, den: int):
    """Only sets of sizes within the ratio num/den can be that similar."""
    return F.least(x, y) * den >= F.greatest(x, y) * num


def _light_product(num: int, den: int):
    """The product over a bucket of columns with few members: pairs (a, b, na, nb, overlap)."""
    def run(rows: pa.Table) -> pa.Table:
        token, cls, n = (np.asarray(rows.column(c)) for c in ("token", "cls", "n"))
        inside = np.asarray(rows.column("inside").combine_chunks().flatten()).reshape(len(n), -1)
        order = np.lexsort((cls, token))
        token, cls, n = token[order], cls[order], n[order]
        found = []
        for k in range(1, LIGHT):
            i = np.flatnonzero(token[k:] == token[:-k])
            i = i[den * np.minimum(n[i], n[i + k]) >= num * np.maximum(n[i], n[i + k])]
            for part in np.array_split(i, len(i) // 100_000 + 1):
                room = np.minimum(inside[order[part]], inside[order[part + k]]).sum(axis=1, dtype=np.int64)
                part = part[room * (den + num) >= (n[part] + n[part + k]) * num]
                found.append(np.stack((cls[part], cls[part + k], n[part], n[part + k]), 1))
        pairs, overlap = np.unique(np.concatenate(found), axis=0, return_counts=True)
        names = ("a", "b", "na", "nb")
        return pa.table({**{c: pa.array(pairs[:, i]) for i, c in enumerate(names)}, "overlap": pa.array(overlap)})
    return run


def _reaches(overlap, num: int, den: int):
    """Can a pair reach the bound: its overlap so far with the most that later columns can add?"""
    later = F.greatest(*[F.expr(f"(({n} * {num} + {den - 1}) div {den}) - 1") for n in ("na", "nb")])
    return (overlap + later) * (den + num) >= (F.col("na") + F.col("nb")) * num


def _light_pairs(light: DataFrame, heavy: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate pairs ``(a, b)`` that meet in a light column. Heavy columns count with all that they
    could add: the smaller number of heavy columns of the two."""
    buckets = max(1, light.count() // BUCKET_ENTRIES)
    part = light.join(classes.select("cls", "inside"), "cls") \
        .withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(buckets)))
    pairs = part.groupBy("bucket").applyInArrow(
        _light_product(num, den), "a long, b long, na long, nb long, overlap long") \
        .groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("overlap"))
    many = heavy.groupBy("cls").agg(F.count("*").alias("h"))
    ha, hb = (many.select(F.col("cls").alias(s), F.col("h").alias("h" + s)) for s in "ab")
    most = F.col("overlap") + F.least(F.coalesce("ha", F.lit(0)), F.coalesce("hb", F.lit(0)))
    return pairs.join(ha, "a", "left").join(hb, "b", "left").where(_reaches(most, num, den)).select("a", "b")


def _may_link(na: str, nb: str, xa: str, xb: str, num: int, den: int):
    """Sizes within the ratio, and enough room for the overlap in every block of columns."""
    room = F.expr(f"aggregate(zip_with({xa}, {xb}, (p, q) -> cast(least(p, q) AS bigint)), 0L, (s, v) -> s + v)")
    return _sizes_fit(na, nb, num, den) & (room * (den + num) >= (F.col(na) + F.col(nb)) * num)


def _undecided(heavy: DataFrame, label: DataFrame | None) -> DataFrame:
    """``(token, cls, n, inside, label)`` of the heavy columns whose members lie in different components."""
    placed = heavy.withColumn("label", F.col("cls")) if label is None else \
        heavy.join(label.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    placed = materialize(placed.select("token", "cls", "n", "inside", "label"), "placed")
    mixed_columns = placed.groupBy("token").agg(F.min("label").alias("l0"), F.max("label").alias("l1")) \
        .where("l0 < l1").select("token")
    return materialize(placed.join(mixed_columns, "token"), "undecided")


def _star(placed: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs ``(a, b)`` of each column's hub with the members of other components. The hub is the
    class that meets most others over all its columns: of a group of near copies, one close to the
    text that they were made from."""
    met = placed.join(placed.groupBy("token").agg(F.count("*").alias("c")), "token") \
        .groupBy("cls").agg(F.sum("c").alias("met"))
    hub = placed.join(met, "cls").groupBy("token") \
        .agg(F.max(F.struct("met", "cls", "n", "label", "inside")).alias("hub")) \
        .select("token", F.col("hub.cls").alias("a"), F.col("hub.n").alias("na"),
                F.col("hub.label").alias("la"), F.col("hub.inside").alias("xa"))
    return (placed.join(hub, (placed["token"] == hub["token"]) & (placed["label"] != hub["la"])
                        & _may_link("n", "na", "inside", "xa", num, den))
            .select("a", F.col("cls").alias("b")).distinct())


def _multiply(num: int, den: int):
    """The product of two blocks of rows over the heavy columns, accumulated in a table of counts."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        def rows(t: pa.Table):
            token, cls, n, label = (np.asarray(t.column(c)) for c in ("token", "cls", "n", "label"))
            ids, first, at = np.unique(cls, return_index=True, return_inverse=True)
            wide = np.asarray(t.column("inside").combine_chunks().flatten()).reshape(len(cls), -1)
            order = np.argsort(token, kind="stable")
            columns, begin = np.unique(token[order], return_index=True)
            return ids, n[first], label[first], wide[first], columns, np.split(at[order], begin[1:])
        out = [np.empty((0, 2), np.int64)]
        if left.num_rows and right.num_rows:
            ia, na, la, xa, ca, ra = rows(left)
            ib, nb, lb, xb, cb, rb = rows(right)
            overlap = np.zeros((len(ia), len(ib)), np.int32)
            _, p, q = np.intersect1d(ca, cb, assume_unique=True, return_indices=True)
            for i, j in zip(p.tolist(), q.tolist()):
                overlap[np.ix_(ra[i], rb[j])] += 1
            same = left.column("block")[0] == right.column("block")[0]
            for i in range(len(ia)):
                later = np.maximum((na[i] * num + den - 1) // den, (nb * num + den - 1) // den) - 1
                ok = (overlap[i] > 0) & (lb != la[i]) & ((overlap[i] + later) * (den + num) >= (na[i] + nb) * num) \
                    & (den * np.minimum(na[i], nb) >= num * np.maximum(na[i], nb))
                if same:
                    ok &= ib > ia[i]
                j = np.flatnonzero(ok)
                j = j[np.minimum(xa[i], xb[j]).sum(axis=1, dtype=np.int64) * (den + num) >= (na[i] + nb[j]) * num]
                out.append(np.stack((np.full(len(j), ia[i]), ib[j]), 1))
        pairs = np.concatenate(out)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})
    return run


def _product(placed: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs ``(a, b)`` of different components that meet in a heavy column and whose overlap in the
    first block, with the most that later columns can add, reaches the bound. (A pair's light columns
    have paired it already.) Classes that share their first column are dealt into blocks of rows of
    bounded size; blocks that share a column are multiplied, and only survivors leave the task."""
    first = placed.groupBy("cls").agg(F.min("token").alias("t"))
    buckets = max(1, first.count() // BLOCK_ROWS)
    first = first.select("cls", F.pmod(F.xxhash64("t"), F.lit(buckets)).alias("bucket"))
    salts = first.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("salts"))
    block = first.join(salts, "bucket").select("cls", F.concat_ws(
        "/", "bucket", F.pmod(F.xxhash64("cls"), F.col("salts"))).alias("block"))
    placed = materialize(placed.join(block, "cls"), "row-blocks")
    holds = placed.select("token", "block").distinct()
    meets = holds.withColumnRenamed("block", "left").join(holds.withColumnRenamed("block", "right"), "token") \
        .where(F.col("left") <= F.col("right")).select("left", "right").distinct()
    meets = materialize(meets, "block-pairs")
    def side(name):  # columns of its own, as the two sides are cogrouped
        dealt = placed.withColumn(name, F.col("block")).join(meets, name)
        return dealt.select(*[F.col(c).alias(c) for c in dealt.columns]).groupBy("left", "right")
    return side("left").cogroup(side("right")).applyInArrow(_multiply(num, den), "a long, b long")


def _keyed(width: int):
    """The class of each row's text, with the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                own = [class_key(s) if len(s) else None for s in shingle_sets(text_column(part, "text"), width)]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), column(part, "text")], ["cls", "text"])
        give_back()
    return run


def _fetch(rows: DataFrame, classes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``(cls, text)`` of the wanted classes, one text each, by their first document; classes that have only
    rows with a null id by the class of those rows."""
    own = materialize(wanted.join(classes, "cls").select("cls", F.col("first_id").alias("doc_id")), "wanted")
    ids, nameless = own.where("doc_id is not null"), own.where("doc_id is null").select("cls")
    if own.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = rows.where("doc_id is not null and text is not null").join(ids, "doc_id") \
        .select("cls", "text").mapInArrow(_texts(width), "cls long, text string")
    if not nameless.isEmpty():
        texts = texts.unionByName(rows.where("doc_id is null and text is not null").select("text")
                                  .mapInArrow(_keyed(width), "cls long, text string").join(nameless, "cls", "left_semi"))
    # rows that repeat an id and a text are one; a task sends one text a class
    return materialize(texts.groupBy("cls").agg(F.first("text").alias("text")), "texts")


def ngram_components(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100,
                     id_column: str = "doc_id", text_column_name: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row: documents link when the Jaccard
    similarity of their sets of ``width``-word shingles is at least ``num / den``;
    component_id is the smallest id that links reach."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       F.col(text_column_name).alias("text"))
    profile = materialize(rows.mapInArrow(
        _profile(width), "doc_id long, n_shingles long, cls long, inside array<int>, slice int, counts binary"), "profile")
    table = spark.sparkContext.broadcast(frequencies(profile))
    per_doc = profile.where("slice is null").select("doc_id", "n_shingles", "cls")
    classes = materialize(profile.where("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"), F.first("inside").alias("inside")), "classes")

    block = materialize(rows.mapInArrow(_entries(width, num, den, table),
                                        "token long, cls long"), "block")
    shared = block.groupBy("token").agg(F.min("cls").alias("low"), F.max("cls").alias("high")) \
        .where("low < high").select("token")
    shared = block.join(shared, "token").distinct().join(classes.select("cls", "n"), "cls").select("token", "cls", "n")
    shared = materialize(shared, "shared")
    free_shuffles(spark)
    # columns of two or three members whose sizes can't go together end here
    mid = "(n1 - n0 - n2)"
    alone = F.expr(f"""(c = 2 AND NOT {den} * n0 >= {num} * n2)
                       OR (c = 3 AND NOT {den} * n0 >= {num} * {mid} AND NOT {den} * {mid} >= {num} * n2)""")
    columns = shared.groupBy("token").agg(F.count("*").alias("c"), F.min("n").alias("n0"), F.sum("n").alias("n1"),
                                          F.max("n").alias("n2")).where(~alone).select("token", "c")
    shared = materialize(shared.join(columns, "token"), "columns")
    heavy = materialize(shared.where(F.col("c") > LIGHT).join(classes.select("cls", "inside"), "cls")
                        .select("token", "cls", "n", "inside"), "heavy")
    light = shared.where(F.col("c") <= LIGHT).select("token", "cls", "n")
    free_shuffles(spark)

    none = spark.createDataFrame([], "a long, b long")
    links, texts, tried = none, spark.createDataFrame([], "cls long, text string"), \
        none.withColumnsRenamed({"a": "lo", "b": "hi"})

    def check(pairs: DataFrame) -> bool:
        """Verify pairs that were not tried before; were there links?"""
        nonlocal links, texts, tried
        pairs = materialize(pairs.select("a", "b", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
                            .join(tried, ["lo", "hi"], "left_anti"), "pairs")
        if pairs.isEmpty():
            return False
        ends = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
        texts = texts.unionByName(_fetch(rows, classes, ends.join(texts.select("cls"), "cls", "left_anti"), width))
        new = materialize(_links(pairs, texts, width, num, den), "links")
        tried = tried.unionByName(pairs.select("lo", "hi"))
        links = links.unionByName(new)
        free_shuffles(spark)
        return not new.isEmpty()

    label = components(links) if check(_light_pairs(light, heavy, classes, num, den)) else None
    found = True
    while True:
        placed = _undecided(heavy, label)
        entries, product = placed.groupBy("token").agg(F.count("*").alias("c")) \
            .agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum(F.expr("c * (c - 1) / 2")), F.lit(0.0))).first()
        if not entries:
            break
        last = not found or product <= 2 * entries
        found = check(_product(placed, num, den) if last else _star(placed, num, den))
        if found:
            label = components(links)
        if last:
            break

    if label is None:
        label = spark.createDataFrame([], "node long, label long")
    named = per_doc.join(label.withColumnRenamed("node", "cls"), "cls", "left") \
        .select("doc_id", "n_shingles", F.coalesce("label", "cls").alias("label"))
    low = named.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("low"))
    return named.join(low, "label", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("low")).alias("component_id"))


def keep_one_per_group(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents with one of each group of near copies: the smallest doc_id. Documents
    without words stay, rows with a null id stay (they can't be told apart), and rows that
    repeat an id stay together with it."""
    found = ngram_components(docs, width, num, den)
    gone = found.where("doc_id > component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
