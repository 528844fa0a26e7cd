"""Folder access through Hadoop's file system API, so any storage Spark can write to works."""

from __future__ import annotations

from pyspark.sql import SparkSession

# How tables and messages are written: texts and flat rows take far less than with the default codec.
COMPACT = {"compression": "zstd"}


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, location: str) -> bool:
    path, system = _path(spark, location)
    return system.exists(path)


def matches_with_time(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Paths given with wildcards and when they were last written, found in one request however many there are."""
    path, system = _path(spark, pattern)
    return [(status.getPath().toString(), status.getModificationTime()) for status in system.globStatus(path) or []]


def any_match(spark: SparkSession, pattern: str) -> bool:
    """Whether anything lies at a location given with wildcards."""
    path, system = _path(spark, pattern)
    return bool(system.globStatus(path))


def child_folders(spark: SparkSession, location: str) -> list[str]:
    """Names of the folders directly below a location, sorted; empty if it does not exist."""
    path, system = _path(spark, location)
    if not system.exists(path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(path) if status.isDirectory())


def delete_folder(spark: SparkSession, location: str) -> None:
    path, system = _path(spark, location)
    system.delete(path, True)


def touch(spark: SparkSession, location: str) -> None:
    """Create an empty file."""
    path, system = _path(spark, location)
    system.create(path, True).close()


def write_text(spark: SparkSession, location: str, text: str) -> None:
    """Create a small text file."""
    path, system = _path(spark, location)
    stream = system.create(path, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()


def read_text(spark: SparkSession, location: str) -> str:
    """A small text file."""
    path, system = _path(spark, location)
    stream = system.open(path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
