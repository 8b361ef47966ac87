"""Arrival order.

First-fit grouping and every tie-break depend on the order items arrive
in: feeds in list order, then search queries in list order, each source
newest first, then position in the payload. That order is a total sort
key; ``ord`` is a LONG that increases with it. It comes from a global
range-partitioned sort followed by ``monotonically_increasing_id`` — no
single-partition window — so hot sources spread over many tasks. The table
is written out so every later stage sees the same numbers even when tasks
are re-run, and the numbers of each sort partition then move down to where the one before
it ends, so ``ord`` is dense: 0, 1, 2, … (one count for each partition goes through the driver).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.operators.materialize import materialize as materialize_df


#: Bits below the partition number in ``monotonically_increasing_id``.
PARTITION_BITS = 33


def arrival_key():
    """Sort key of arrival: source kind, source position, source name,
    newest first, payload position, item id."""
    return [F.col("source_kind").asc(), F.col("source_order").asc(), F.col("source").asc(),
            F.col("pub_time").desc(), F.col("item_order").asc(), F.col("item_id").asc()]


def with_arrival_order(df: DataFrame, materialize: bool = True) -> DataFrame:
    """Add ``ord``: unique, increasing in arrival order, and dense if written out."""
    out = df.orderBy(*arrival_key()).withColumn("ord", F.monotonically_increasing_id())
    if not materialize:
        return out
    out = materialize_df(out, "arrival")
    part, first, before = F.shiftright("ord", PARTITION_BITS), [], 0
    for r in out.groupBy(part.alias("part")).count().orderBy("part").collect():  # a row for each sort partition
        first += [F.lit(r["part"]), F.lit(before - (r["part"] << PARTITION_BITS))]
        before += r["count"]
    return out.withColumn("ord", F.col("ord") + F.create_map(*first)[part]) if first else out
