"""Best-fit packing under conflicts (operator 2).

Documents become sequences (bins) of at most ``capacity`` words. A text longer than that is cut into full
windows, each a bin of its own, and a rest. Rests are packed largest first: each goes into the open bin with
the least room that still holds it and has neither a document of the same source nor one of the same
duplicate cluster (equal texts but for case and white space); if there is none, it opens a bin.

Open bins are kept in the order of their room left. The search starts at the first bin with enough room
and goes on to its successors until one is compatible, so it finds the tightest compatible bin. Each bin
carries two bitmaps, of its sources and of its clusters.

Packing is greedy and sequential, so it runs in shards: items are dealt by a hash of their id and text into
shards of about ``SHARD_DOCS`` documents, whose number follows the input; each is packed whole by one task. A
source with a third of all rows is a third of every shard. Rows that repeat (same id, source and text) are counted
first and dealt in lots of up to ``LOT`` copies, so they spread over all shards too. Only ids, lengths and counts are
shuffled, not texts.

Defined results: a text without words (or null) gives a row with no bin. A null source conflicts with
nothing. Rows that repeat are items of their own, of one cluster. Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
SHARD_DOCS = 4000
LOT = 64
#: Lots are listed in two steps, as one list of all lots of a row would grow with its copies.
LOTS_A_STEP = 1024

PACKED = "doc_id long, chunk int, bin_id long, position int, offset int, start_word long, n_words int"


def pack(items: list[tuple[int, int, int]], capacity: int) -> list[int]:
    """The bin of each item ``(size, source, cluster)``, in the order given; a source below 0 is none."""
    room: list[tuple[int, int]] = []  # (room left, bin), ascending
    sources: list[int] = []
    clusters: list[int] = []
    out = []
    for size, source, cluster in items:
        own, same = (1 << source) if source >= 0 else 0, 1 << cluster
        at = bisect_left(room, (size, -1))
        while at < len(room) and (sources[room[at][1]] & own or clusters[room[at][1]] & same):
            at += 1
        if at < len(room):
            left, k = room.pop(at)
            sources[k] |= own
            clusters[k] |= same
        else:
            left, k = capacity, len(sources)
            sources.append(own)
            clusters.append(same)
        if left > size:
            insort(room, (left - size, k))
        out.append(k)
    return out


def _pack_shard(capacity: int):
    def run(rows: pa.Table) -> pa.Table:
        number: dict[str, dict] = {"source": {}, "cluster": {}}
        items = []
        cols = [rows.column(c).to_pylist() for c in ("shard", "doc_id", "n_words", "source", "cluster", "copies")]
        for shard, doc, n, source, cluster, copies in zip(*cols):
            s = -1 if source is None else number["source"].setdefault(source, len(number["source"]))
            c = number["cluster"].setdefault(cluster, len(number["cluster"]))
            for chunk in range(-(-n // capacity)):
                size = min(capacity, n - chunk * capacity)
                items += [(-size, doc if doc is not None else -(1 << 63), cluster, chunk, s, c, doc)] * copies
            if not n:
                items += [(1, 0, cluster, 0, s, c, doc)] * copies  # last: no words, no bin
        items.sort(key=lambda x: x[:4])
        real = [x for x in items if x[0] < 0]
        base = (cols[0][0] << 32) if cols[0] else 0
        fill: dict[int, list[int]] = {}
        out = []
        for x, k in zip(real, pack([(-x[0], x[4], x[5]) for x in real], capacity)):
            at = fill.setdefault(k, [0, 0])
            out.append((x[6], x[3], base + k, at[0], at[1], x[3] * capacity, -x[0]))
            at[0] += 1
            at[1] -= x[0]
        out += [(x[6], 0, None, None, None, 0, 0) for x in items if x[0] > 0]
        cols = list(zip(*out)) if out else [()] * 7
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
        names = [c.split()[0] for c in PACKED.split(", ")]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, cols, kinds)})
    return run


def best_fit(docs: DataFrame, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """``PACKED`` rows: each piece of each document of ``docs(doc_id, text, source)`` with its bin, its
    place and word offset in the bin, and where in the document it starts."""
    shards = max(1, -(-docs.count() // shard_docs))
    text = F.coalesce("text", F.lit(""))
    plain = F.lower(F.regexp_replace(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]++", " ")), "^ | $", ""))
    items = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")).cast("long").alias("n_words"),
                        F.xxhash64(plain).alias("cluster"))
    step = LOT * LOTS_A_STEP
    lots = items.groupBy("doc_id", "source", "n_words", "cluster").agg(F.count("*").alias("n")) \
        .withColumn("step", F.explode(F.expr(f"sequence(0L, (n - 1) div {step})"))) \
        .withColumn("n", F.expr(f"least({step}, n - step * {step})")) \
        .withColumn("lot", F.explode(F.expr(f"sequence(0L, (n - 1) div {LOT})"))) \
        .select("doc_id", "source", "n_words", "cluster", F.expr(f"least({LOT}, n - lot * {LOT})").alias("copies"),
                F.pmod(F.xxhash64("doc_id", "cluster", "step", "lot"), F.lit(shards)).alias("shard"))
    return lots.groupBy("shard").applyInArrow(_pack_shard(capacity), PACKED)
