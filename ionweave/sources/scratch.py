"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under spark.checkpoint.dir. Where that is unset, a local session, as in tests, takes a temporary folder of
    this machine; on a cluster it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def _found(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    files, p = _found(spark, path)
    return files.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where it isn't there."""
    files, p = _found(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(p) if s.isDirectory()) if files.exists(p) else []


def holds_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a file whose name doesn't mark it as hidden."""
    files, p = _found(spark, path)
    return any(s.isFile() and s.getPath().getName()[0] not in "._" for s in files.listStatus(p))


def delete(spark: SparkSession, path: str) -> None:
    files, p = _found(spark, path)
    files.delete(p, True)


def stamp(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Names, sizes and times of a file, or of the files in a folder: another stamp means other contents."""
    files, p = _found(spark, path)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in files.listStatus(p)))
