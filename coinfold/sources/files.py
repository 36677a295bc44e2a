"""Small files and folders on whatever file system the tables lie on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class AlreadyThere(RuntimeError):
    """Another writer has put a file of that name."""


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    fs, there = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(there)) if fs.exists(there) else []


def size(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of some files."""
    return sum(fs.getFileStatus(there).getLen() for fs, there in (_at(spark, p) for p in paths))


def read(spark: SparkSession, path: str) -> str:
    fs, there = _at(spark, path)
    stream = fs.open(there)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put(spark: SparkSession, path: str, text: str) -> None:
    """A file that is there whole or not at all: written under another name and renamed.

    A file of that name is never replaced. Two writers at once are told apart by the file system's
    rename; one that replaces files would need a single writer.
    """
    fs, there = _at(spark, path)
    fs.mkdirs(there.getParent())
    draft = _at(spark, f"{there.getParent()}/.{uuid.uuid4().hex}")[1]
    stream = fs.create(draft)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(there) or not fs.rename(draft, there):
        fs.delete(draft, False)
        raise AlreadyThere(path)


def remove(spark: SparkSession, path: str) -> None:
    """A file or folder with all that is in it; nothing if there is none."""
    fs, there = _at(spark, path)
    fs.delete(there, True)
