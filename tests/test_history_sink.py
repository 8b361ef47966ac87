"""Published history (S7-S10, E20) and the digest sink."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from storyloom.operators.digest import push_message, push_title, write_digests
from storyloom.operators import history as H
from storyloom.operators.history import (POINTER, append_history, expire, expire_stored, expired,
                                         merged_history, read_history, unseen)
from storyloom.params import DIGEST_EMPTY, PUSH_EMPTY_NOTICE


def _hist(spark, rows):
    return spark.createDataFrame(rows, "url string, title string, fetch_time timestamp")


def test_e20_published_link_dropped_and_time_kept(spark):
    t0 = dt.datetime(2026, 3, 30, 8, 0)
    hist = _hist(spark, [("https://a/1", "old title", t0)])
    batch = spark.createDataFrame(
        [(1, "https://a/1", "new title", 1), (2, "https://b/2", "other", 2), (3, "https://b/2", "dup", 3)],
        "item_id long, link string, title string, rank int")
    assert [r.item_id for r in unseen(batch, hist).orderBy("item_id").collect()] == [2, 3]
    merged = {r.url: r for r in merged_history(batch, hist, "2026-04-01 00:00:00").collect()}
    assert merged["https://a/1"].title == "old title" and merged["https://a/1"].fetch_time == t0
    assert merged["https://b/2"].title == "other"  # first by rank wins, one row per link
    assert len(merged) == 2


def test_append_is_insert_if_absent_and_expiry(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="hist-", dir="/tmp"), "history")
    assert read_history(spark, path).count() == 0  # S8: missing table reads as empty
    batch = spark.createDataFrame([(1, "u1", "t1", 1), (2, "u2", "t2", 2)],
                                  "item_id long, link string, title string, rank int")
    append_history(batch, path, "2026-03-20 00:00:00")
    append_history(batch, path, "2026-04-01 00:00:00")  # same links again: nothing new
    h = read_history(spark, path)
    assert h.count() == 2
    assert {r.fetch_time for r in h.collect()} == {dt.datetime(2026, 3, 20)}
    assert expire(h, "2026-04-01 00:00:00", 7).count() == 0
    assert expired(h, "2026-04-01 00:00:00", 7).count() == 2
    assert expire(h, "2026-04-01 00:00:00", 30).count() == 2


def test_stored_history_expires_by_date_folders(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="hist-", dir="/tmp"), "history")
    times = {"a": "2026-03-20 10:00:00", "b": "2026-03-25 08:00:00", "c": "2026-03-25 12:00:00", "d": "2026-03-31 00:00:00"}
    for i, (link, t) in enumerate(times.items()):
        append_history(spark.createDataFrame([(i, link, link, 1)], "item_id long, link string, title string, rank int"), path, t)
    def folders():
        with open(os.path.join(path, POINTER)) as f:
            return json.load(f)["folders"]
    before = folders()
    assert expire_stored(spark, path, "2026-04-01 09:00:00", 7) == 2
    assert sorted(r.url for r in read_history(spark, path).collect()) == ["c", "d"]
    after = folders()
    assert not [f for f in after if f.endswith("2026-03-20")]
    # later dates are the same folders; the edge date has a new one; the version before can still be read
    assert [f for f in after if f.endswith("03-31")] == [f for f in before if f.endswith("03-31")]
    assert not set(f for f in after if f.endswith("03-25")) & set(before)
    assert all(os.listdir(os.path.join(path, f)) for f in before)
    assert expire_stored(spark, path, "2026-04-01 09:00:00", 7) == 0
    assert expire_stored(spark, path + "-none", "2026-04-01 09:00:00", 7) == 0


def test_a_change_that_dies_leaves_the_version_before(spark, monkeypatch):
    path = os.path.join(tempfile.mkdtemp(prefix="hist-", dir="/tmp"), "history")
    schema = "item_id long, link string, title string, rank int"
    for i, t in enumerate(["2026-03-20 10:00:00", "2026-03-25 08:00:00", "2026-03-25 12:00:00"]):
        append_history(spark.createDataFrame([(i, f"u{i}", "t", 1)], schema), path, t)

    def urls():
        return sorted(r.url for r in read_history(spark, path).collect())

    def dies(*a):
        raise RuntimeError("killed")
    point = H._point
    monkeypatch.setattr(H, "_point", dies)  # all data is written, the pointer is not
    with pytest.raises(RuntimeError):
        expire_stored(spark, path, "2026-04-01 09:00:00", 7)
    assert urls() == ["u0", "u1", "u2"]
    with pytest.raises(RuntimeError):
        append_history(spark.createDataFrame([(9, "u9", "t", 1)], schema), path, "2026-04-01 00:00:00")
    assert urls() == ["u0", "u1", "u2"]
    monkeypatch.setattr(H, "_point", point)
    assert expire_stored(spark, path, "2026-04-01 09:00:00", 7) == 2 and urls() == ["u2"]
    append_history(spark.createDataFrame([(9, "u9", "t", 1)], schema), path, "2026-04-01 00:00:00")
    assert urls() == ["u2", "u9"]


def test_plain_date_folders_are_adopted(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="hist-", dir="/tmp"), "history")
    _hist(spark, [("a", "t", dt.datetime(2026, 3, 20)), ("b", "t", dt.datetime(2026, 3, 31)), ("n", "t", None)]) \
        .withColumn("fetch_date", F.to_date("fetch_time")).write.partitionBy("fetch_date").parquet(path)
    assert expire_stored(spark, path, "2026-04-01 09:00:00", 7) == 1
    assert sorted(r.url for r in read_history(spark, path).collect()) == ["b", "n"]


def test_unreadable_history_is_an_error(spark):
    path = tempfile.mkdtemp(prefix="hist-", dir="/tmp")
    with open(os.path.join(path, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        read_history(spark, path).collect()


def test_digest_sink_and_push(spark):
    docs = spark.createDataFrame([("en", "doc en"), ("de", "doc de")], "digest_key string, document string")
    out = os.path.join(tempfile.mkdtemp(prefix="digest-", dir="/tmp"), "d")
    write_digests(docs, out, "monday")
    own = write_digests(docs.withColumn("document", F.lit("later")), out, "tuesday")
    assert sorted(n for n in os.listdir(own) if n.startswith("digest_key=")) == ["digest_key=de", "digest_key=en"]
    text = spark.read.text(os.path.join(out, "run=monday", "digest_key=en")).collect()
    assert [r.value for r in text] == ["doc en"]  # an earlier run's digest stays
    one = write_digests(spark.createDataFrame([("", "x")], docs.schema), out, "all-in-one")
    assert "digest_key=all" in os.listdir(one)
    title = push_title("2026-03-30 09:00:00")
    assert title.endswith("2026年03月30日")
    msg = push_message(docs.filter("digest_key = 'en'"), title).first().message
    assert msg == "# " + title + "\n\ndoc en"
    empty = push_message(docs.limit(1).withColumn("document", F.lit(DIGEST_EMPTY)), title,
                         empty_run=True).first().message
    assert empty.endswith(PUSH_EMPTY_NOTICE)
