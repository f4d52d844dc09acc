"""Folders of any file system that Spark reads: listed, claimed, deleted."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def subfolders(spark: SparkSession, path: str) -> dict[str, int]:
    """Names of the folders in a folder, each with the time of its last change; none if it is not there."""
    files, where = _at(spark, path)
    if not files.exists(where):
        return {}
    found = [status for status in files.listStatus(where) if status.isDirectory()]
    return {status.getPath().getName(): status.getModificationTime() for status in found}


def delete(spark: SparkSession, path: str) -> None:
    files, where = _at(spark, path)
    files.delete(where, True)


def write_once(spark: SparkSession, path: str, text: str) -> str:
    """Write a small file unless it is there, and give what it holds: of several writers, one wins.

    The text is written aside and renamed without replacing, which file systems with a rename of
    their own do in one step.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files, where = _at(spark, path)
    if not files.exists(where):
        _, aside = _at(spark, f"{path}.{uuid.uuid4().hex}")
        out = files.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf).rename(aside, where, options)
        except Py4JJavaError as taken:
            files.delete(aside, False)
            if not taken.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                raise
    held = files.open(where)
    try:
        return bytes(held.readAllBytes()).decode()
    finally:
        held.close()
