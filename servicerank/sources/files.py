"""Folders and small files through Hadoop's file systems, wherever the tables are."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Stored:
    """A file: its path, bytes, and time of the last change in epoch milliseconds."""

    path: str
    size: int
    changed: int


def locate(spark: SparkSession, path: str) -> tuple:
    """A Hadoop path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = found.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(found), files


def exists(spark: SparkSession, path: str) -> bool:
    found, files = locate(spark, path)
    return files.exists(found)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or a whole folder; False if there is none."""
    found, files = locate(spark, path)
    return files.delete(found, True)


def stored(spark: SparkSession, path: str, hidden: bool = False) -> Iterator[Stored]:
    """Files below a folder, none if there is no such folder; those in hidden folders or of hidden names if asked for."""
    root, files = locate(spark, path)
    if not files.exists(root):
        return
    entries, depth = files.listFiles(root, True), len(root.toString()) + 1
    while entries.hasNext():
        status = entries.next()
        name = status.getPath().toString()
        if hidden or not any(step.startswith(("_", ".")) for step in name[depth:].split("/")):
            yield Stored(name, status.getLen(), status.getModificationTime())


def read_json(spark: SparkSession, path: str) -> dict:
    """The content of a published file."""
    found, files = locate(spark, path)
    source = files.open(found)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    finally:
        source.close()


def publish(spark: SparkSession, path: str, content: dict) -> bool:
    """Write a JSON file in one step, unless there is one: False if somebody was first.

    The content is complete when the name appears: it is written under a hidden
    name and renamed without overwriting, which file systems with an atomic
    rename do for one caller only.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, files = locate(spark, path)
    if files.exists(target):
        return False
    hidden = hadoop.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = files.create(hidden, False)
    try:
        out.write(bytearray((json.dumps(content) + "\n").encode()))
    finally:
        out.close()
    keep = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(hidden, target, keep)
    except Py4JJavaError as failed:
        files.delete(hidden, False)
        if failed.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True
