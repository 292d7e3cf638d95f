"""Small texts (state, reports) on whatever file system a path names, through Hadoop's interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as files' metadata have it, but not URL-encoded."""
    at, fs = _at(spark, path)
    return fs.makeQualified(at).toString()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The file's text in UTF-8; none if there is no such file."""
    at, fs = _at(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes beside the file first, so that a reader never meets half of it."""
    at, fs = _at(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    stream = fs.create(new, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    fs.delete(at, False)
    if not fs.rename(new, at):
        raise OSError(f"{path} can't be written")
