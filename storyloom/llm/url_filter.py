"""URL filters by a temporal list join (operator 8), in DataFrame functions only.

A list is a log of dated entries: from ``at`` on, a ``host`` (exact) or a ``domain`` (the name and
everything below it) is listed or unlisted. The entries of one key cut time into validity intervals; a
capture is judged by the entries active when it was fetched, not by today's list.

1. :func:`intervals`: entries of one key and time become one (a listing wins), entries that change
   nothing are left out, and each of the rest ends where the key's next one begins.
2. :func:`evaluate`: a capture looks up its host and each parent domain of two labels or more, as of its
   fetch time. Keys and times that repeat are looked up once.

Looking up the previous or next entry is an as-of join whose windows hold one key and one stretch of time
(``BUCKET_BITS``), with the last entry of each stretch carried to the next by a second window over one row a
stretch; so a host with a third of all captures is spread over as many tasks as it has stretches.

Defined results: an entry counts from its own instant on. Entries without a key or time are ignored. A
capture without a URL, host or fetch time is not blocked. Repeated rows of a capture give a row each. A
user part, port, trailing dot and case are not part of a host. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.operators.asof import latest_before
from storyloom.operators.materialize import materialize

#: Stretches of 2**33 half-microseconds, a little over an hour.
BUCKET_BITS = 33
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host_of(url: str) -> Column:
    """The host of a URL in lower case; null without one."""
    host = F.lower(F.regexp_replace(F.regexp_extract(url, HOST, 1), r"\.+$", ""))
    return F.when(host != "", host)


def keys_of(host: str) -> Column:
    """What may list a host: itself, and each of its domains of two labels or more."""
    return F.expr(f"""CASE WHEN {host} IS NOT NULL THEN concat(
        array(named_struct('kind', 'host', 'key', {host})),
        transform(sequence(0, greatest(size(split({host}, '[.]')) - 2, 0)),
                  i -> named_struct('kind', 'domain', 'key', array_join(slice(split({host}, '[.]'), i + 1,
                                    size(split({host}, '[.]'))), '.')))) END""")


def intervals(entries: DataFrame) -> DataFrame:
    """``(kind, key, valid_from, valid_to)`` in microseconds, of the listed stretches only; valid_to is
    null while listed. ``entries``: (kind, key, at as microseconds, listed)."""
    one = (entries.where("kind is not null and key is not null and at is not null and listed is not null")
           .groupBy("kind", "key", "at").agg(F.max("listed").alias("listed")))
    marks = materialize(one.select("kind", "key", F.col("at").alias("ord"), "listed"), "marks")
    before = latest_before(marks, marks, ["kind", "key"], BUCKET_BITS - 1)
    was = marks.select("kind", "key", F.col("ord").alias("prev"), F.col("listed").alias("was"))
    turns = materialize(marks.join(before, ["kind", "key", "ord"]).join(was, ["kind", "key", "prev"], "left")
                        .where("listed <> coalesce(was, false)").select("kind", "key", "ord", "listed"), "turns")
    # the next turn is the latest one on the reversed axis
    back = turns.select("kind", "key", (-F.col("ord")).alias("ord"))
    after = latest_before(back, back, ["kind", "key"], BUCKET_BITS - 1) \
        .select("kind", "key", (-F.col("ord")).alias("ord"), (-F.col("prev")).alias("valid_to"))
    return turns.where("listed").join(after, ["kind", "key", "ord"]) \
        .select("kind", "key", F.col("ord").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``(capture_id, host, fetched, blocked, n_active, since)`` for each row of ``captures(capture_id,
    url, fetched as microseconds)``: how many active entries match, and since when the oldest has held."""
    listed = materialize(intervals(entries), "intervals")
    rows = captures.select("capture_id", host_of("url").alias("host"), "fetched")
    wanted = rows.where("host is not null and fetched is not null").select("host", "fetched").distinct() \
        .select("host", "fetched", F.explode(keys_of("host")).alias("x")) \
        .select("host", "fetched", "x.kind", "x.key")
    # doubled times: an entry at the very instant of a fetch comes before it
    probes = wanted.select("kind", "key", (2 * F.col("fetched") + 1).alias("ord")).distinct()
    builds = listed.select("kind", "key", (2 * F.col("valid_from")).alias("ord"))
    found = latest_before(probes, builds, ["kind", "key"], BUCKET_BITS).where("prev is not null") \
        .select("kind", "key", F.expr("(ord - 1) div 2").alias("fetched"), F.expr("prev div 2").alias("valid_from"))
    active = (wanted.join(found, ["kind", "key", "fetched"]).join(listed, ["kind", "key", "valid_from"])
              .where("valid_to is null or fetched < valid_to")
              .groupBy("host", "fetched").agg(F.count("*").alias("n_active"), F.min("valid_from").alias("since")))
    return rows.join(active, ["host", "fetched"], "left").select(
        "capture_id", "host", "fetched", F.coalesce(F.col("n_active") > 0, F.lit(False)).alias("blocked"),
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), "since")
