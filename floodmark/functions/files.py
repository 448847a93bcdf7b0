"""Small files in any store that Spark reaches, such as manifests."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a file, None if there is none."""
    files, at = _place(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file as a whole; False if there is one already, which stays."""
    files, at = _place(spark, path)
    _, beside = _place(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = files.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not files.exists(at) and files.rename(beside, at):
        return True
    files.delete(beside, False)
    return False


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if there is no such folder."""
    files, at = _place(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    files, at = _place(spark, path)
    files.delete(at, True)
