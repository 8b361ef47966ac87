"""Per-item filters and projections.

All are narrow, row-local expressions: on a cluster they run in the scan
stage, and the recency predicate reaches the Parquet reader as a pushed
filter (and a partition filter when the landing table is partitioned by
date).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.functions.scoring import is_excluded, keyword_score
from storyloom.functions.text import col_, short_summary
from storyloom.functions.time import recent_since
from storyloom.params import (NO_ABSTRACT_MARKER, NO_ABSTRACT_SITE,
                              NO_ABSTRACT_URL_PART, DigestParams)
from storyloom.sources.tables import SOURCE_KIND_FEED

CANDIDATE_COLUMNS = ["item_id", "source_kind", "source_order", "source", "item_order",
                     "site", "title", "link", "summary", "pub_time", "pub_date",
                     "comments", "kw_score", "lang"]


def recent(df: DataFrame, params: DigestParams) -> DataFrame:
    """keep ``pub_time >= as_of - days``; inclusive, no upper bound."""
    return df.filter(F.col("pub_time") >= recent_since(params.as_of, params.days_limit))


def with_summary(df: DataFrame, params: DigestParams, text_col: str = "content") -> DataFrame:
    """X2 on the item's clean text."""
    return df.withColumn("summary", short_summary(text_col, params.summary_max_length))


def no_abstract_marker(url_parts=(NO_ABSTRACT_URL_PART,), sites=(NO_ABSTRACT_SITE,),
                       feed_url="feed_url", site="site", source_kind="source_kind") -> Column:
    """F6 predicate: a feed whose URL holds a marked part or whose name is a
    marked site (defaults: the fixed host and site name)."""
    url = F.coalesce(col_(feed_url), F.lit(""))
    hit = F.lit(False)
    for part in url_parts:
        hit = hit | F.contains(url, F.lit(part))
    for name in sites:
        hit = hit | (col_(site) == F.lit(name))
    return (col_(source_kind) == SOURCE_KIND_FEED) & hit


def apply_marker(df: DataFrame, params: DigestParams | None = None) -> DataFrame:
    """replace the summary by the fixed marker text (after truncation)."""
    p = params or DigestParams()
    return df.withColumn("summary", F.when(no_abstract_marker(p.marker_url_parts, p.marker_sites),
                                           F.lit(NO_ABSTRACT_MARKER))
                         .otherwise(F.col("summary")))


def exclude(df: DataFrame, params: DigestParams) -> DataFrame:
    """drop items whose title or (truncated) summary holds an excluded word."""
    if not params.exclude_keywords:
        return df
    return df.filter(~is_excluded("title", "summary", params.exclude_keywords))


def score(df: DataFrame, params: DigestParams) -> DataFrame:
    """X1 as column ``kw_score``."""
    return df.withColumn("kw_score", keyword_score("title", "summary",
                                                   params.high_weight_keywords).cast("int"))


def comment_count(text) -> Column:
    """F8: integer when the text is all ASCII digits, else 0."""
    digits = F.regexp_extract(F.coalesce(col_(text).cast("string"), F.lit("")), r"^[0-9]+\z", 0)
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def prepare_candidates(raw: DataFrame, params: DigestParams,
                       history: DataFrame | None = None) -> DataFrame:
    """Raw article records -> scored candidates, in the per-item order of
    the reference: recency, published-history, truncate, marker, exclude,
    score. Cheap predicates first; the anti-join runs before any text work.
    """
    from storyloom.operators.history import unseen  # local: avoids a cycle

    df = recent(raw, params)
    if history is not None:
        df = unseen(df, history)
    df = with_summary(df, params)
    df = apply_marker(df, params)
    df = exclude(df, params)
    df = score(df, params)
    return df.select(*CANDIDATE_COLUMNS)
