"""Looking at and removing folders, on whatever file system Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; nothing if there is no such folder."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(where))


def make(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.mkdirs(where)


def remove(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    system, where = _at(spark, path)
    stream = system.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete or not there; one of that name must not exist."""
    system, where = _at(spark, path)
    if system.exists(where):
        raise FileExistsError(path)
    part = where.suffix(".part")
    stream = system.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not system.rename(part, where):
        raise FileExistsError(path)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Give a file or folder another name; one of that name must not exist."""
    system, where = _at(spark, path)
    _, there = _at(spark, target)
    system.mkdirs(there.getParent())
    if system.exists(there) or not system.rename(where, there):
        raise FileExistsError(target)


def files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path below the folder, bytes) of all files in it and below, sorted; nothing if there is no such folder."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return []
    found, listed = [], system.listFiles(where, True)
    root = system.resolvePath(where).toUri().getPath().rstrip("/")
    while listed.hasNext():
        status = listed.next()
        found.append((status.getPath().toUri().getPath()[len(root) + 1:], status.getLen()))
    return sorted(found)
