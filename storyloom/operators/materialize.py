"""Cut lineage by writing an intermediate table to the shared checkpoint
folder (``spark.checkpoint.dir``) and reading it back.

Unlike ``Dataset.checkpoint``, which runs the plan once to count and
once more to save unless the data is cached, a Parquet write runs the
plan once; the re-read table has file statistics, so AQE can size joins
over it. A lost executor never loses the result: it lives in shared
storage, not in executor memory or machine-local folders.

Tables stay until :func:`release` is called (a finished job calls it
once its own results are written).
"""

from __future__ import annotations

import gc
import itertools
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from storyloom.session import scratch_path

_RUN = uuid.uuid4().hex[:12]
_COUNTER = itertools.count()
_WRITTEN: list[str] = []


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name for an intermediate table of this run."""
    path = scratch_path(spark, os.path.join(_RUN, f"{next(_COUNTER):05d}-{label}"))
    _WRITTEN.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def collect_garbage(spark: SparkSession) -> None:
    """Have the driver's JVM collect: shuffle files of plans that nothing refers to stay on the executors' disks until it does."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def mark() -> int:
    """Position in the list of tables written so far, for :func:`release`."""
    return len(_WRITTEN)


def release(spark: SparkSession, since: int = 0, until: int | None = None) -> int:
    """Delete the intermediate tables written since ``since`` (and before ``until``); returns how many."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    for path in _WRITTEN[since:until]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(p.getFileSystem(conf).delete(p, True))
    del _WRITTEN[since:until]
    return gone
