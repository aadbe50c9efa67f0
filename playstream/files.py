"""Small files and folders in whatever file system a path names, through Spark's own connection to it."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no such folder."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def matches(spark: SparkSession, pattern: str) -> int:
    """How many files and folders match a pattern."""
    fs, p = _at(spark, pattern)
    return len(fs.globStatus(p) or [])


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file so that readers see all of it or none; False, and nothing
    changed, where the file was there before."""
    fs, p = _at(spark, path)
    if fs.exists(p):
        return False
    hidden = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(hidden)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.exists(p) and fs.rename(hidden, p):
        return True
    fs.delete(hidden, False)
    return False


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
