"""Small text files in the file system that tables lie in, put there once."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def system_of(spark: SparkSession, path: str):
    """The file system of a path, through the interface Spark itself uses, and its class of paths."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Put a whole text at ``path`` unless something is there; True if it was put.

    The text is written beside and then renamed, which file systems such as HDFS
    do only if the name is free; on a local one the name is linked, for the same
    reason. A store without either needs a table format of its own.
    """
    jvm = spark.sparkContext._jvm
    system, place = system_of(spark, path)
    goal = system.makeQualified(place(path))
    aside = place(goal.getParent(), f".{uuid.uuid4().hex}")
    out = system.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if goal.toUri().getScheme() == "file":
            files, paths = jvm.java.nio.file.Files, jvm.java.nio.file.Paths
            try:
                files.createLink(paths.get(goal.toUri()), paths.get(aside.toUri()))
                return True
            except Exception:
                if system.exists(goal):
                    return False
                raise
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(goal.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(aside, goal, options)
            return True
        except Exception:
            if system.exists(goal):
                return False
            raise
    finally:
        system.delete(aside, False)


def read_text(spark: SparkSession, path: str) -> str:
    system, place = system_of(spark, path)
    source = system.open(place(path))
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if it is not there."""
    system, place = system_of(spark, folder)
    if not system.exists(place(folder)):
        return []
    return [status.getPath().getName() for status in system.listStatus(place(folder)) if not status.getPath().getName().startswith(".")]


def delete(spark: SparkSession, path: str) -> None:
    system, place = system_of(spark, path)
    system.delete(place(path), True)
