"""Small file-system helpers that work on every Hadoop file system, local or object store."""

from __future__ import annotations

import posixpath

from pyspark.sql import SparkSession


def join_path(*parts: str) -> str:
    return posixpath.join(*parts)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a pattern; used for directories whose number does not grow with the data."""
    fs, hadoop_path = _file_system(spark, pattern)
    found = fs.globStatus(hadoop_path)
    return sorted(status.getPath().toString() for status in (found or []))


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def make_until_exit(spark: SparkSession, path: str) -> None:
    """Make a folder that goes, with all in it, when the application ends."""
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
