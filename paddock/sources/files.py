"""File listing and sizes through the Hadoop file system of the session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a pattern, in name order; empty if there are none."""
    path = _path(spark, pattern)
    found = _system(spark, path).globStatus(path)
    return sorted(str(f.getPath().toString()) for f in found or [])


def qualified(spark: SparkSession, text: str) -> str:
    """The whole path, with its file system."""
    path = _path(spark, text)
    return str(_system(spark, path).makeQualified(path).toString())


def size(spark: SparkSession, text: str) -> int:
    """Bytes under a file or folder."""
    path = _path(spark, text)
    return int(_system(spark, path).getContentSummary(path).getLength())


def stamp(spark: SparkSession, pattern: str) -> tuple:
    """Names, sizes and times of the paths matching a pattern: another one once they change."""
    path = _path(spark, pattern)
    found = _system(spark, path).globStatus(path)
    return tuple(
        sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found or [])
    )


def exists(spark: SparkSession, text: str) -> bool:
    path = _path(spark, text)
    return bool(_system(spark, path).exists(path))


def remove(spark: SparkSession, text: str) -> None:
    """Delete a file or folder, if it is there."""
    path = _path(spark, text)
    _system(spark, path).delete(path, True)


def stem(path: str) -> str:
    """Lower-cased file name without its extension."""
    return path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0].lower()
