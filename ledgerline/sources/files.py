"""Small files and folders of the shared store, through its own file system."""
from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None if there is none."""
    at, store = _path(spark, path)
    if not store.exists(at):
        return None
    stream = store.open(at)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def swap_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a file in the place of another in one step: readers see the old content or the new one."""
    jvm = spark.sparkContext._jvm
    at, store = _path(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.next")
    stream = store.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    options = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    how = spark.sparkContext._gateway.new_array(options, 1)
    how[0] = options.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(store.makeQualified(beside), store.makeQualified(at), how)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    at, store = _path(spark, path)
    store.delete(at, True)


def children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names in a folder with their bytes, folders with those of all their files; nothing for a missing folder."""
    at, store = _path(spark, path)
    if not store.exists(at):
        return []
    return sorted((s.getPath().getName(), store.getContentSummary(s.getPath()).getLength()) for s in store.listStatus(at))
