"""Small operations on any file system that Spark can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str) -> tuple:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def names_below(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, none when it is missing."""
    system, folder = _located(spark, path)
    if not system.exists(folder):
        return []
    return [status.getPath().getName() for status in system.listStatus(folder)]


def exists(spark: SparkSession, path: str) -> bool:
    system, found = _located(spark, path)
    return system.exists(found)


def bytes_below(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, zero when it is missing."""
    system, folder = _located(spark, path)
    return system.getContentSummary(folder).getLength() if system.exists(folder) else 0


def read_text(spark: SparkSession, path: str) -> str:
    """A short text file."""
    system, file = _located(spark, path)
    stream = system.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a short text file in place by one rename; False if the name is taken.

    Readers see the whole file or none. The rename never replaces a file.
    """
    system, file = _located(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(file.getParent(), f".{uuid.uuid4().hex}")
    system.mkdirs(file.getParent())
    stream = system.create(beside, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    try:
        return not system.exists(file) and system.rename(beside, file)
    finally:
        system.delete(beside, False)


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, read without the rest of it."""
    system, file = _located(spark, path)
    jvm, stream = spark._jvm, system.open(file)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine() or ""
    finally:
        stream.close()
