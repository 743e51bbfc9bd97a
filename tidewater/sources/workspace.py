"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a temporary folder in a local session and the warehouse on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="tidewater-")
    else:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    spark.sparkContext.setCheckpointDir(root)
    return root
