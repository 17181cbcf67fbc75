"""Folders for intermediate files."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, removed when the process ends; in local mode
    one of our own where that is unset. Elsewhere it must be set, as executors don't see a folder
    of the driver."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        given = "file://" + tempfile.gettempdir()
    path = f"{given}/lumenframe-{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone already; the cluster clears the folder then
        pass
