"""Small files of a lake, through Hadoop's file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path)"""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    files, found = hadoop_path(spark, path)
    return files.exists(found)


def delete(spark: SparkSession, path: str) -> None:
    files, found = hadoop_path(spark, path)
    files.delete(found, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    files, found = hadoop_path(spark, path)
    return [s.getPath().getName() for s in files.listStatus(found) if s.isDirectory()] if files.exists(found) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None if it is not there."""
    files, found = hadoop_path(spark, path)
    if not files.exists(found):
        return None
    stream = files.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that a reader sees the old content or the new one, never a part."""
    files, target = hadoop_path(spark, path)
    _, beside = hadoop_path(spark, f"{path}-{uuid.uuid4().hex}")
    stream = files.create(beside, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    jvm = spark._jvm
    option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(beside), files.makeQualified(target), options)
