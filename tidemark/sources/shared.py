"""Paths in the folder that all executors share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

_leaving: set[str] = set()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, in a folder that goes as the driver ends.  Only a local session,
    whose tasks run on this machine, may do without the setting."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = f"file:/tmp/checkpoints/{spark.sparkContext.applicationId}"
    folder = f"{found.rstrip('/')}/tables-{spark.sparkContext.applicationId}"
    if folder not in _leaving:
        _leaving.add(folder)
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return f"{folder}/{name}-{uuid.uuid4().hex}"
