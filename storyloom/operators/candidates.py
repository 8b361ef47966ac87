"""Similar title-key pairs (C4, C5) over *distinct* normalised titles.

Items are never paired directly: exact copies share a key and are
linked by a chain (see :mod:`storyloom.operators.grouping`), so a title
carried by a third of all rows costs one key here.

* containment (C4): keys of length >= 5 meet where they pick the same
  hashed gram (:mod:`storyloom.operators.landmarks`), so the work is linear
  in the characters of the keys and in the pairs found.
* ratio (C5): 0.65 is too low a threshold for a lossless filter by shared
  tokens. Keys are dealt into leaves of similar content by a tree of character
  counts and lengths; leaves whose envelopes cannot reach the ratio never
  meet, and a key goes only to the leaves that it can reach itself
  (:mod:`storyloom.operators.envelopes`). A task compares two blocks by array
  operations and emits similar pairs only. Long titles of one language still
  have much the same characters, so the work on those stays
  quadratic; ``approximate`` is the way out (:mod:`storyloom.operators.approximate`).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.functions.similarity import block_verdicts
from storyloom.operators.envelopes import build_tree, can_reach, envelopes, placed
from storyloom.operators.landmarks import bit_set, common_landmarks, looked_up, sent
from storyloom.operators.materialize import materialize
from storyloom.params import CONTAINMENT_MIN_LEN


def distinct_keys(items: DataFrame) -> DataFrame:
    """(digest_key, key, klen) for every non-empty normalised title."""
    return (items.filter(F.col("key") != "").select("digest_key", "key").distinct()
            .withColumn("klen", F.length("key")))


def numbered_keys(keys: DataFrame) -> DataFrame:
    """The keys written out with ``kid``, a number for each: pairs of keys are pairs of numbers, as texts are long."""
    if "kid" in keys.columns:
        return keys
    return materialize(keys.withColumn("kid", F.monotonically_increasing_id()), "keys")


#: Characters of the keys whose landmarks are picked at a time, as inner and as outer keys.
INNER_CHARS, OUTER_CHARS = 1_000_000, 500_000


def contained_ids(keys: DataFrame) -> DataFrame:
    """``(ikid, kid, begin, ilen)``: pairs of distinct keys of :func:`numbered_keys` with the inner one in the other, and a place of it there.

    Texts are not sent to each other. An inner key is looked up by one landmark, the outer keys send the hashes and
    places of theirs (:mod:`storyloom.operators.landmarks`); where they meet, the piece of the outer
    key at that place is compared with the inner key by length and SHA-256. So the shuffles hold a few rows a key, the
    keys once, and a few numbers a pair."""
    sc = keys.sparkSession.sparkContext
    long = keys.where(F.col("klen") >= CONTAINMENT_MIN_LEN)
    inner = looked_up(long, sc.broadcast(common_landmarks(long)), INNER_CHARS)
    digest = long.select("kid", "klen", F.unhex(F.sha2("key", 256)).alias("digest"))
    inner = materialize(inner.join(digest, "kid").select(
        "digest_key", "mark", F.col("kid").alias("ikid"), F.col("place").alias("iplace"), F.col("klen").alias("ilen"), "digest"), "landmarks")
    outer = sent(long, sc.broadcast(bit_set(inner)), OUTER_CHARS)
    met = outer.join(inner, ["digest_key", "mark"]).where("kid <> ikid and place >= iplace") \
        .select("kid", "ikid", (F.col("place") - F.col("iplace")).cast("int").alias("begin"), "ilen", "digest")
    piece = F.col("key").substr(F.col("begin") + 1, F.col("ilen"))
    found = met.join(long.select("kid", "klen", "key"), "kid") \
        .where((F.col("begin") + F.col("ilen") <= F.col("klen")) & (F.unhex(F.sha2(piece, 256)) == F.col("digest")))
    return materialize(found.groupBy("kid", "ikid").agg(F.min("begin").alias("begin"), F.min("ilen").alias("ilen")), "contained")


def containment_pairs(keys: DataFrame) -> DataFrame:
    """Ordered pairs (inner, outer) of distinct keys with ``inner`` in ``outer``. The inner text is cut out of the
    outer one, so no text is sent for a pair."""
    keys = numbered_keys(keys)
    found = contained_ids(keys).join(keys.select("digest_key", "kid", "key"), "kid")
    return found.select("digest_key", F.col("key").substr(F.col("begin") + 1, F.col("ilen")).alias("inner"), F.col("key").alias("outer"))


#: Keys of a block (bounds a task's arrays).
BLOCK_KEYS = 512

PAIRS = "a long, b long, a_later boolean, b_later boolean"


def _verdicts(threshold: float):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        _, lleaf, lsalt, rleaf, rsalt = (k.as_py() for k in key)
        if left.num_rows and right.num_rows:
            a, b = left.column("key").to_pylist(), right.column("key").to_pylist()
            number = dict(zip(a + b, left.column("kid").to_pylist() + right.column("kid").to_pylist()))
            same = (lleaf, lsalt) == (rleaf, rsalt)
            if same:
                a = b = sorted(a)
            for x, y, xy, yx in block_verdicts(a, b, threshold, same):
                m, n = number[x], number[y]
                out.append((m, n, xy, yx) if m < n else (n, m, yx, xy))
        cols = list(zip(*out)) if out else [()] * 4
        return pa.table({"a": pa.array(cols[0], pa.int64()), "b": pa.array(cols[1], pa.int64()),
                         "a_later": pa.array(cols[2], pa.bool_()), "b_later": pa.array(cols[3], pa.bool_())})
    return run


def ratio_work(keys: DataFrame, threshold: float, number: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The pairs of blocks that can hold a similar pair, and the copies of keys that are sent to each as the left and
    the right side."""
    keys = numbered_keys(keys)
    number = keys.count() if number is None else number
    tree = keys.sparkSession.sparkContext.broadcast(build_tree(keys, number))
    own = materialize(placed(keys, tree), "placed-keys")
    env = materialize(envelopes(own).withColumn("salts", F.ceil(F.col("n") / BLOCK_KEYS)), "envelopes")
    names = ("leaf", "low", "high", "shortest", "longest", "salts")
    x, y = (env.select("digest_key", *[F.col(c).alias(side + c) for c in names]) for side in "lr")
    meets = materialize(x.join(y, "digest_key").where(f"lleaf <= rleaf and {can_reach(threshold, 'l', 'r')}"), "leaf-pairs")
    by = ["digest_key", "lleaf", "lsalt", "rleaf", "rsalt"]
    every = {side: F.explode(F.sequence(F.lit(0).cast("long"), F.col(side + "salts") - 1)).alias(side + "salt") for side in "lr"}
    blocks = meets.select("*", every["l"]).select("*", every["r"]).where("lleaf < rleaf or lsalt <= rsalt")
    salted = own.join(env.select("digest_key", "leaf", "salts"), ["digest_key", "leaf"]) \
        .withColumn("salt", F.pmod(F.xxhash64("key"), F.col("salts")))
    sides = []
    for side, other in ("lr", "rl"):
        # a key alone is an envelope too
        alone = salted.select("digest_key", "key", "kid", F.col("leaf").alias(side + "leaf"), F.col("salt").alias(side + "salt"),
                              F.col("counts").alias("klow"), F.col("counts").alias("khigh"),
                              F.col("klen").alias("kshortest"), F.col("klen").alias("klongest"))
        rest = blocks.select(*by, *[F.col(other + c) for c in names[1:5]])
        sent = alone.join(rest, ["digest_key", side + "leaf", side + "salt"]).where(can_reach(threshold, "k", other))
        sides.append(sent.select(*[F.col(c).alias(c) for c in (*by, "key", "kid")]))
    return blocks.select(*by), sides[0], sides[1]


def ratio_ids(keys: DataFrame, threshold: float, number: int | None = None) -> DataFrame:
    """``PAIRS``: pairs a < b of numbers of distinct keys with ratio > t in an order."""
    _, left, right = ratio_work(keys, threshold, number)
    by = ["digest_key", "lleaf", "lsalt", "rleaf", "rsalt"]
    # the work is the square of the rows, so small shuffles must not be joined into few tasks
    spark = keys.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    left, right = left.repartition(tasks, *by), right.repartition(tasks, *by)
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_verdicts(threshold), PAIRS)


def similar_key_ids(keys: DataFrame, threshold: float, use_ratio: bool = True) -> DataFrame:
    """``PAIRS``: pairs (a < b) of numbers of distinct similar keys (:func:`numbered_keys`) with the
    direction verdicts ``a_later`` (item with key a later than item with key b
    is similar) and ``b_later``. Containment is symmetric."""
    cont = contained_ids(keys).select(F.least("ikid", "kid").alias("a"), F.greatest("ikid", "kid").alias("b"),
                                      F.lit(True).alias("a_later"), F.lit(True).alias("b_later"))
    if not use_ratio:
        return cont
    return cont.unionByName(ratio_ids(keys, threshold)).groupBy("a", "b") \
        .agg(F.bool_or("a_later").alias("a_later"), F.bool_or("b_later").alias("b_later"))


def _texts(pairs: DataFrame, keys: DataFrame) -> DataFrame:
    """Pairs of numbers as ``(digest_key, a, b, a_later, b_later)`` with texts a < b."""
    first = keys.select(F.col("kid").alias("a"), "digest_key", F.col("key").alias("m"))
    second = keys.select(F.col("kid").alias("b"), F.col("key").alias("n"))
    order = F.col("m") < F.col("n")
    return pairs.join(first, "a").join(second, "b").select(
        "digest_key", F.least("m", "n").alias("a"), F.greatest("m", "n").alias("b"),
        F.when(order, F.col("a_later")).otherwise(F.col("b_later")).alias("a_later"),
        F.when(order, F.col("b_later")).otherwise(F.col("a_later")).alias("b_later"))


def ratio_pairs(keys: DataFrame, threshold: float, number: int | None = None) -> DataFrame:
    """Unordered pairs a < b of distinct keys with ratio > t in an order, with their verdicts."""
    keys = numbered_keys(keys)
    return _texts(ratio_ids(keys, threshold, number), keys)


def similar_key_pairs(keys: DataFrame, threshold: float, use_ratio: bool = True) -> DataFrame:
    """:func:`similar_key_ids` with the keys themselves."""
    keys = numbered_keys(keys)
    return _texts(similar_key_ids(keys, threshold, use_ratio), keys)
