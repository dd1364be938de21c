"""Where builds keep their tables."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def folder_of(spark: SparkSession, base: str | None = None) -> str:
    """``base``, or the folder in ``spark.checkpoint.dir``.

    Every executor must see the folder. Where neither is set, the folder is the
    warehouse, which executors and driver share anyway.
    """
    base = base or spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.conf.get("spark.sql.warehouse.dir")
    return base.rstrip("/")


def new_location(spark: SparkSession, label: str, base: str | None = None) -> str:
    """A fresh path in the workspace."""
    return f"{folder_of(spark, base)}/wordloom-{label}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, location: str) -> bool:
    path, filesystem = _hadoop_path(spark, location)
    return filesystem.exists(path)


def discard(spark: SparkSession, location: str) -> None:
    """Delete a table this package wrote."""
    path, filesystem = _hadoop_path(spark, location)
    filesystem.delete(path, True)


def _numbered(folder: str, number: int) -> str:
    return f"{folder}/{number:012d}.json"


def claim(spark: SparkSession, folder: str, number: int, content: dict) -> bool:
    """Write entry ``number`` of a folder unless there is one; returns whether it is ours.

    The storage decides who comes first, by creating a file that must not exist yet.
    """
    path, filesystem = _hadoop_path(spark, _numbered(folder, number))
    try:
        out = filesystem.create(path, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    return True


def entries_in(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the entries of a folder, in order."""
    path, filesystem = _hadoop_path(spark, folder)
    if not filesystem.exists(path):
        return []
    names = [one.getPath().getName() for one in filesystem.listStatus(path)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0].isdigit())


def entry(spark: SparkSession, folder: str, number: int) -> dict | None:
    """The content of an entry; None while its writer is not done with it."""
    path, filesystem = _hadoop_path(spark, _numbered(folder, number))
    length = filesystem.getFileStatus(path).getLen()
    opened = filesystem.open(path)
    try:
        data = bytes(opened.readNBytes(length))
    finally:
        opened.close()
    try:
        return json.loads(data)
    except ValueError:
        return None
