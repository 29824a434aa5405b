"""Folders in the storage that a session's paths name, on any file system Spark reaches."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system."""
    fs, where = _at(spark, path)
    return fs.makeQualified(where).toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, in order; none if it is not there."""
    fs, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()) if fs.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def scratch(spark: SparkSession) -> str:
    """A new folder name for what a query writes and reads again, in the folder that ``spark.checkpoint.dir`` or the session's checkpoints name.

    Where neither is set, Spark in one process takes a local folder and a cluster gets an error, as executors do not share theirs.
    """
    sc = spark.sparkContext
    top = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not top:
        if not re.fullmatch(r"local(\[[^-]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = tempfile.mkdtemp(prefix="tractworks-")
    return f"{top.rstrip('/')}/written-{uuid.uuid4().hex}"
