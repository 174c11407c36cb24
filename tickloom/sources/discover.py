"""Input files of a directory, in any store that Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..errors import Error, ReplayError


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def discover(spark: SparkSession, directory: str, kind: str, extension: str) -> list[str]:
    """Regular files directly in directory whose names end with .<kind>.<extension>, sorted by the bytes of their paths: that
    order is the sources' order. Nothing if it isn't a directory."""
    store, at = _store(spark, directory)
    if not store.exists(at) or not store.getFileStatus(at).isDirectory():
        return []
    found = [s.getPath().toString() for s in store.listStatus(at) if s.isFile() and s.getPath().getName().endswith(f".{kind}.{extension}")]
    return sorted(found, key=lambda p: p.encode())


def detect_format(spark: SparkSession, directory: str, kind: str) -> str:
    """csv or json, whichever files there are; an error for both or neither."""
    found = [e for e in ("csv", "json") if discover(spark, directory, kind, e)]
    if len(found) != 1:
        what = "both csv and json files" if found else "neither csv nor json files"
        raise ReplayError(Error.CONFIG_INVALID, f"format auto: {what} of kind {kind} in {directory!r}; only csv and json are read")
    return found[0]


def first_line(spark: SparkSession, path: str) -> str | None:
    """A file's first line without its line feed; None for an empty file. Only the driver reads, and only that line."""
    store, at = _store(spark, path)
    try:
        stream = store.open(at)
    except Exception as e:
        raise ReplayError(Error.FILE_OPEN, path) from e
    try:
        scanner = spark.sparkContext._jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\n")
        if scanner.hasNext():
            return scanner.next()
        return None if store.getFileStatus(at).getLen() == 0 else ""
    finally:
        stream.close()
