"""Small operations on the cluster's file system (any Hadoop URI), driver side: directory
listings, tiny documents, renames.  Only names and documents of a few bytes pass here, never rows."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is directory) of the entries of a directory, sorted; a missing one has none."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted((s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(p))


def subdirectories(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    return [n for n, is_dir in children(spark, path) if is_dir and n.startswith(prefix)]


def read_document(spark: SparkSession, path: str) -> str:
    """Text of a small document."""
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_document(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small document under its final name in one step: a temporary file is renamed, and
    the rename refuses to replace.  False if the document is there already."""
    p, fs = _path(spark, path)
    temp, _ = _path(spark, f"{p.getParent()}/.{p.getName()}.{os.urandom(6).hex()}")
    stream = fs.create(temp, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(context.makeQualified(temp), context.makeQualified(p), none)
    except Exception as e:  # noqa: BLE001
        fs.delete(temp, False)
        if "FileAlreadyExists" not in str(e):
            raise
        return False
    return True


def set_time(spark: SparkSession, path: str, millis: int) -> None:
    """Set the modification time of a file."""
    p, fs = _path(spark, path)
    fs.setTimes(p, millis, -1)


def rename(spark: SparkSession, old: str, new: str) -> None:
    p, fs = _path(spark, old)
    q, _ = _path(spark, new)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"cannot rename {old} to {new}")


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a directory with its files; False if there is none."""
    p, fs = _path(spark, path)
    return fs.exists(p) and fs.delete(p, True)
