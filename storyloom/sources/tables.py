"""Landed input tables and the ``articles`` view built over them.

The ``articles`` view turns the driver's ``documents``/``pages``/``events``
tables into raw article records: one landed source whose items carry a
site, a title (the whole first line of the text), a link
(the page URL, else a synthetic one), clean text, a publish time and a
comment count.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.functions.text import first_line

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Column order of a raw article record, whatever the source.
RAW_COLUMNS = ["item_id", "source_kind", "source_order", "source", "item_order", "site",
               "title", "link", "content", "pub_time", "pub_date", "comments",
               "feed_url", "lang"]

SOURCE_KIND_FEED = 0
SOURCE_KIND_SEARCH = 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw article records from ``documents`` + ``pages`` + ``events``.

    Joins are on the item key; Catalyst prunes ``documents`` to the five
    columns used, ``events`` to three and ``pages`` to two.
    """
    # the title is cut off ahead of the joins, so where only that is used no whole text is shuffled
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text", first_line("text").alias("title"))
    ev = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"),
        F.col("ts").cast("timestamp").alias("pub_time"),
        F.floor("value").cast("bigint").alias("comments"))
    pg = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"),
                                              F.col("url").alias("page_url"))
    j = docs.join(ev, "doc_id", "inner").join(pg, "doc_id", "left")
    return j.select(
        F.col("doc_id").alias("item_id"),
        F.lit(SOURCE_KIND_FEED).alias("source_kind"),
        F.lit(0).alias("source_order"),
        F.col("source").alias("source"),
        F.col("doc_id").alias("item_order"),
        F.col("source").alias("site"),
        F.col("title"),
        F.coalesce("page_url", F.concat(F.lit("https://"), F.col("source"),
                                        F.lit(".example/"), F.col("doc_id").cast("string"))).alias("link"),
        F.col("text").alias("content"),
        F.col("pub_time"),
        F.to_date("pub_time").alias("pub_date"),
        F.col("comments"),
        F.lit("").alias("feed_url"),
        F.col("lang"),
    )


_AS_OF: dict[str, str] = {}


def articles_as_of(spark: SparkSession, sf_dir: str):
    """``as_of`` for fixture runs: the newest publish time in the view
    (one scalar aggregate, memoised per read-only input folder)."""
    if sf_dir in _AS_OF:
        return _AS_OF[sf_dir]
    ev = table(spark, sf_dir, "events")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("event_id"))
    row = ev.join(docs, "event_id", "left_semi").agg(
        F.date_format(F.max(F.col("ts").cast("timestamp")),
                      "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("m")).first()
    _AS_OF[sf_dir] = row["m"]
    return row["m"]
