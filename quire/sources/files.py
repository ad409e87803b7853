"""Folders that driver and executors share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, the path, and the class of paths."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where, jvm.org.apache.hadoop.fs.Path


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path under spark.checkpoint.dir, removed when the driver ends. Only where driver and executors are one process may the session name none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file:///tmp/checkpoints"
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    fs, where, _ = file_system(spark, path)
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return path
