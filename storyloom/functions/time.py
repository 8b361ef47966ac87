"""Date parsing and formatting."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from storyloom.functions.text import col_
from storyloom.params import DIGEST_LOCAL_ZONE, DIGEST_TIME_FORMAT

_WEEKDAY = r"^\s*[A-Za-z]{3},\s*"


def parse_feed_time(text) -> Column:
    """RFC 822 dates (``Mon, 30 Mar 2026 08:00:00 +0800`` or ``... GMT``)
    and ISO 8601 text to a UTC timestamp; anything else is NULL.

    Spark's pattern language has no weekday-name parser, so the weekday is
    stripped first. Each form is parsed by exactly one branch.
    """
    t = F.trim(col_(text))
    no_wd = F.regexp_replace(t, _WEEKDAY, "")
    return F.coalesce(
        F.try_to_timestamp(no_wd, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(no_wd, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(no_wd, F.lit("d MMM yyyy HH:mm Z")),
        F.try_to_timestamp(no_wd, F.lit("d MMM yyyy HH:mm z")),
        t.try_cast("timestamp"),
    )


def ts_lit(value) -> Column:
    """A timestamp literal in UTC from a datetime (naive means UTC) or ISO text.

    Passing text avoids any dependence on the Python process's zone.
    """
    if value is None:
        return F.lit(None).cast("timestamp")
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp")


def resolve_feed_time(published, updated, as_of) -> Column:
    """published, else updated, else the run's ``as_of``."""
    return F.coalesce(parse_feed_time(published), parse_feed_time(updated),
                      ts_lit(as_of))


def resolve_search_time(published_date, as_of) -> Column:
    """ISO text (``Z`` means UTC) or ``as_of`` when absent or unparseable.
    Text without an offset is read as UTC."""
    return F.coalesce(col_(published_date).try_cast("timestamp"),
                      ts_lit(as_of))


def search_pub_date(published_date, pub_time) -> Column:
    """Date in the offset the text came with: the first ten characters of a
    parseable ISO text, else the UTC date of ``pub_time``."""
    raw = col_(published_date)
    ok = raw.try_cast("timestamp").isNotNull()
    return F.when(ok, F.substring(raw, 1, 10).try_cast("date")) \
        .otherwise(F.to_date(col_(pub_time)))


def local_time_text(ts) -> Column:
    """Timestamp shown in the digest's zone as ``yyyy-MM-dd HH:mm``."""
    return F.date_format(F.from_utc_timestamp(col_(ts), DIGEST_LOCAL_ZONE),
                         DIGEST_TIME_FORMAT)


def recent_since(as_of, days: int) -> Column:
    """Lower bound of F1: ``as_of`` minus ``days`` days."""
    if as_of is None:
        raise ValueError("as_of is required")
    return ts_lit(as_of) - F.make_dt_interval(F.lit(days))
