"""Published history.

The history is a Parquet table ``(url STRING, title STRING, fetch_time
TIMESTAMP)`` with ``url`` unique, in folders by fetch date. It
grows by an insert-if-absent append; expiry drops whole dates and rewrites
the one date that the cutoff falls into.

Its folder is a *snapshot*: a pointer file lists the date folders of the current version. A change writes new
folders beside the old ones, then replaces the pointer by one atomic rename, so a job that dies at any point
leaves the version before it, whole. Nothing that a version lists is ever written to again. Folders that neither the current
version nor the one before it lists are deleted after a change, so readers of the version before
are not disturbed. A folder without a pointer (plain ``fetch_date=`` folders) is read as it is, and the first change adopts
it. One writer at a time changes a history.

Lookups are a left-anti join on the link: the history is bounded by
the retention window, and AQE turns the join into a broadcast hash join
at run time when the table is small, a sort-merge join otherwise.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storyloom.functions.time import ts_lit

HISTORY_SCHEMA = T.StructType([
    T.StructField("url", T.StringType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("fetch_time", T.TimestampType(), True),
])


def empty_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], HISTORY_SCHEMA)


POINTER = "_current.json"


def _hadoop(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def _snapshot(spark: SparkSession, path: str) -> dict | None:
    """The pointer's content: version, its folders and those of the version before; None without a pointer."""
    fs, p = _hadoop(spark, f"{path}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _adopted(spark: SparkSession, path: str) -> dict:
    """The snapshot, or one of the plain date folders that lie there."""
    now = _snapshot(spark, path)
    if now is not None:
        return now
    fs, root = _hadoop(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(root)] if fs.exists(root) else []
    return {"version": 0, "folders": sorted(n for n in names if n.startswith("fetch_date=")), "before": []}


def _point(spark: SparkSession, path: str, snapshot: dict) -> None:
    """Make a snapshot the current one: a file beside the pointer takes its name in one step."""
    fs, draft = _hadoop(spark, f"{path}/.{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(snapshot).encode()))
    out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    fs, final = _hadoop(spark, f"{path}/{POINTER}")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
        fs.makeQualified(draft), fs.makeQualified(final), how)


def _change(spark: SparkSession, path: str, now: dict, folders: list[str]) -> None:
    """Publish the next version, then delete what neither it nor the one before lists."""
    _point(spark, path, {"version": now["version"] + 1, "folders": folders, "before": now["folders"]})
    for folder in set(now["before"]) - set(folders) - set(now["folders"]):
        fs, p = _hadoop(spark, f"{path}/{folder}")
        fs.delete(p, True)


def _write_folders(rows: DataFrame, path: str) -> list[str]:
    """Write rows into date folders of their own; their names below ``path``."""
    spark, data = rows.sparkSession, f"data-{uuid.uuid4().hex}"
    rows.withColumn("fetch_date", F.to_date("fetch_time")).write.partitionBy("fetch_date").parquet(f"{path}/{data}")
    fs, root = _hadoop(spark, f"{path}/{data}")
    return sorted(f"{data}/{f.getPath().getName()}" for f in fs.listStatus(root) if f.isDirectory())


def _read_folders(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    if not folders:
        return empty_history(spark)
    return spark.read.schema(HISTORY_SCHEMA).parquet(*[f"{path}/{f}" for f in folders]).select("url", "title", "fetch_time")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The current version at ``path``, or an empty one when there is none yet."""
    now = _snapshot(spark, path)
    if now is not None:
        return _read_folders(spark, path, now["folders"])
    return read_or_empty(spark, path, HISTORY_SCHEMA).select("url", "title", "fetch_time")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path``; an empty one if there is no such path. Any
    other failure is raised: a history that can't be read is not an empty one."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def unseen(df: DataFrame, history: DataFrame, link_col: str = "link") -> DataFrame:
    """Drop items whose link was published before."""
    h = history.select(F.col("url").alias("__url"))
    return df.join(h, df[link_col] == h["__url"], "left_anti")


def new_history_rows(published: DataFrame, history: DataFrame, fetch_time) -> DataFrame:
    """Rows to append for published items: one per link not yet in the
    history; the first title of a link in the batch wins (by item order)."""
    batch = published.groupBy(F.col("link").alias("url")).agg(
        F.min_by("title", F.struct("rank", "item_id")).alias("title"))
    fresh = batch.join(history.select("url"), "url", "left_anti")
    return fresh.select("url", "title", ts_lit(fetch_time).alias("fetch_time"))


def merged_history(published: DataFrame, history: DataFrame, fetch_time) -> DataFrame:
    """History after S9: old rows unchanged plus the new ones."""
    return history.select("url", "title", "fetch_time").unionByName(
        new_history_rows(published, history, fetch_time))


def append_history(published: DataFrame, history_path: str, fetch_time) -> None:
    """S9 as a write: the next version of the table at ``history_path`` has new folders with the new rows."""
    spark = published.sparkSession
    now = _adopted(spark, history_path)
    new = _write_folders(new_history_rows(published, read_history(spark, history_path), fetch_time), history_path)
    if new:
        _change(spark, history_path, now, now["folders"] + new)


def expire(history: DataFrame, as_of, days: int) -> DataFrame:
    """Rows whose ``fetch_time`` is not older than ``as_of - days``."""
    cutoff = ts_lit(as_of) - F.make_dt_interval(F.lit(days))
    return history.filter(F.col("fetch_time") >= cutoff)


def expired(history: DataFrame, as_of, days: int) -> DataFrame:
    """Rows S10 removes (their count is A9)."""
    cutoff = ts_lit(as_of) - F.make_dt_interval(F.lit(days))
    return history.filter(F.col("fetch_time") < cutoff)


def expire_stored(spark: SparkSession, path: str, as_of, days: int) -> int:
    """S10 as a write on the stored table: the next version has no folders of dates before the cutoff's, new
    ones for what stays of the cutoff's own date, and all later ones as they are.
    Returns how many rows went (A9)."""
    gone = expired(read_history(spark, path), as_of, days).count()
    if not gone:
        return 0
    cutoff = spark.range(1).select(F.date_format(
        F.to_date(ts_lit(as_of) - F.make_dt_interval(F.lit(days))), "yyyy-MM-dd")).first()[0]
    now = _adopted(spark, path)
    later, edge = [], []
    for folder in now["folders"]:
        date = re.search(r"fetch_date=([^/]*)$", folder).group(1)
        if date > cutoff or not date[:1].isdigit():  # rows without a time never expire
            later.append(folder)
        elif date == cutoff:
            edge.append(folder)
    kept = _write_folders(expire(_read_folders(spark, path, edge), as_of, days), path) if edge else []
    _change(spark, path, now, kept + later)
    return gone
