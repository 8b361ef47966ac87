"""Disk and driver memory of jobs of many steps."""

from __future__ import annotations

import gc

from pyspark.sql import SparkSession


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps whose results are already written.
    It does so once the driver has collected the objects that stand for them. The heap that the
    driver took to plan these steps goes back to the system with them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
