"""Spark session helpers.

The engine never invents its own storage locations on a cluster: the
shared checkpoint folder comes from ``spark.checkpoint.dir``. Only when
that setting is absent *and* the master is local (a laptop, a unit test)
do we pick a scratch folder ourselves; any other master without the
setting is refused.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "storyloom", extra: dict | None = None) -> SparkSession:
    """Session for tests, benches and local runs."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Settings every job of the engine relies on (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def is_local_master(master: str) -> bool:
    """True for ``local``, ``local[N]`` and ``local[N,F]``: driver and executors are one
    process, so a machine-local folder is shared. ``local-cluster`` is not."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local_master(sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: on a cluster it must name a folder that the "
                f"driver and all executors share (master: {sc.master})")
        configured = tempfile.mkdtemp(prefix="storyloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint location for materialised tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "storyloom", name)
