"""Folders of tables, on whatever file system their paths name."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _folder(spark, path)
    return fs.exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder; none where it is missing."""
    fs, target = _folder(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, target = _folder(spark, path)
    return fs.getContentSummary(target).getLength()


def changed_at(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 at which a file or folder last changed."""
    fs, target = _folder(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder or file, if it is there."""
    fs, target = _folder(spark, path)
    fs.delete(target, True)


def create_file(spark: SparkSession, path: str, replace: bool = True) -> None:
    """An empty file, made in one step; an error where there is one that must not be replaced."""
    fs, target = _folder(spark, path)
    fs.create(target, replace).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that is seen when it is whole; one of that name that is already there stays."""
    fs, target = _folder(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid4().hex}")
    out = fs.create(hidden, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if fs.exists(target) or not fs.rename(hidden, target):
        fs.delete(hidden, False)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _folder(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
