"""File listing through Hadoop's file system API, so any cluster storage works."""

from __future__ import annotations

import re
import time
from urllib.parse import unquote

from pyspark.sql import SparkSession


RELEASE_EVERY = 10.0  # seconds; at size a step takes longer
_released = [float("-inf")]


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def plain(path: str) -> str:
    """A path without percent-encoding and without its scheme's empty authority."""
    return re.sub(r"^file:/+", "file:/", unquote(path))


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _open(spark, path)
    return fs.exists(hadoop_path)


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names directly below a directory; none when it does not exist."""
    hadoop_path, fs = _open(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def leaves(spark: SparkSession, path: str) -> list[str]:
    """The data files at a path: the file itself, or those directly in a folder."""
    hadoop_path, fs = _open(spark, path)
    found = (status.getPath() for status in fs.listStatus(hadoop_path))
    return sorted(p.toString() for p in found if not p.getName().startswith(("_", ".")))


def length_and_time(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes of a file, and when it was last changed in milliseconds."""
    hadoop_path, fs = _open(spark, path)
    status = fs.getFileStatus(hadoop_path)
    return status.getLen(), status.getModificationTime()


def first_line(spark: SparkSession, path: str, encoding: str) -> str | None:
    """The first line of a file; None when it is empty."""
    hadoop_path, fs = _open(spark, path)
    java = spark._jvm.java.io
    reader = java.BufferedReader(java.InputStreamReader(fs.open(hadoop_path), encoding))
    try:
        return reader.readLine()
    finally:
        reader.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    hadoop_path, fs = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> None:
    """Writes a small text file, which must not exist unless it is to be replaced."""
    hadoop_path, fs = _open(spark, path)
    stream = fs.create(hadoop_path, replace)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or a folder with all it holds; nothing when it does not exist."""
    hadoop_path, fs = _open(spark, path)
    fs.delete(hadoop_path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Has Spark remove the shuffle files of finished work, at most every RELEASE_EVERY seconds.

    Its cleaner removes them once a garbage collection of the driver finds their plan unused.
    A driver makes little garbage and asks for none for half an hour, so the rows that were
    shuffled for tables long written would stay on the executors' disks.
    """
    if time.monotonic() - _released[0] >= RELEASE_EVERY:
        _released[0] = time.monotonic()
        spark._jvm.System.gc()
