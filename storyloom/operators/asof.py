"""Bounded as-of lookup: for each probe row, the largest build ``ord`` that
is smaller than the probe's ``ord`` within the same key.

This one primitive gives the chains that stand in for "same link" and
"same title" groups and the edges between similar title keys. A plain
window partitioned by the key would put a hot key (a third of all rows)
into one task; here the ``ord`` axis is cut into buckets of at most
``2**bucket_bits`` consecutive rows of one sort partition:

1. within ``(key, bucket)`` a running max over a window bounded by the
   bucket size;
2. per ``(key, bucket)`` the max build ord (a partial/final aggregate),
   carried forward over the buckets of the key by a second window whose
   partitions hold one row per bucket;
3. a join of the carried value back to the probes of each bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_BITS = 20


def latest_before(probes: DataFrame, builds: DataFrame, keys: list[str],
                  bucket_bits: int = DEFAULT_BUCKET_BITS, with_first: bool = False) -> DataFrame:
    """Return ``keys + [ord, prev]`` for every probe row; ``prev`` is NULL
    when no build row of the key comes earlier. With ``with_first`` also
    ``first``: the key's smallest build ord (NULL-free when any build exists)."""
    p = probes.select(*keys, F.col("ord").alias("__o"), F.lit(1).alias("__p"))
    b = builds.select(*keys, F.col("ord").alias("__o"), F.lit(0).alias("__p"))
    u = p.unionByName(b).withColumn("__b", F.shiftright(F.col("__o"), bucket_bits))
    build_ord = F.when(F.col("__p") == 0, F.col("__o"))

    w_in = (Window.partitionBy(*keys, "__b").orderBy(F.col("__o").asc(), F.col("__p").desc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = u.withColumn("__in", F.max(build_ord).over(w_in)).filter(F.col("__p") == 1)

    per_bucket = u.groupBy(*keys, "__b").agg(F.max(build_ord).alias("__bm"),
                                             F.min(build_ord).alias("__bmin"))
    w_carry = (Window.partitionBy(*keys).orderBy("__b")
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = per_bucket.withColumn("__carry", F.max("__bm").over(w_carry))
    if with_first:
        w_all = Window.partitionBy(*keys)
        carry = carry.withColumn("__first", F.min("__bmin").over(w_all))
    carry = carry.drop("__bm", "__bmin")

    out = inside.join(carry, [*keys, "__b"], "left")
    cols = [*keys, F.col("__o").alias("ord"), F.coalesce("__in", "__carry").alias("prev")]
    if with_first:
        cols.append(F.col("__first").alias("first"))
    return out.select(*cols)
