"""Folder listing through Hadoop's file system, whatever store it is."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, location: str):
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, in name order; empty when there are none."""
    system, path = _path(spark, pattern)
    found = system.globStatus(path)
    return sorted(str(status.getPath().toString()) for status in (found or []))


def exists(spark: SparkSession, location: str) -> bool:
    system, path = _path(spark, location)
    return bool(system.exists(path))


def size(spark: SparkSession, location: str) -> int:
    """Bytes below a path."""
    system, path = _path(spark, location)
    return int(system.getContentSummary(path).getLength())


def delete(spark: SparkSession, location: str) -> bool:
    system, path = _path(spark, location)
    return bool(system.delete(path, True))


def of_partition(spark: SparkSession, table: str, column: str, value: object) -> str:
    """Folder of one value of a partition column, spelled as Spark spells it."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    spelled = "__HIVE_DEFAULT_PARTITION__" if value is None else names.escapePathName(str(value))
    return f"{table.rstrip('/')}/{names.escapePathName(column)}={spelled}"


def exchange(spark: SparkSession, prepared: str, location: str) -> None:
    """Put a finished folder in the place of another one, if there is one."""
    system, path = _path(spark, location)
    system.mkdirs(path.getParent())
    system.delete(path, True)
    if not system.rename(_path(spark, prepared)[1], path):
        raise OSError(f"{prepared} cannot take the place of {location}")


def move(spark: SparkSession, location: str, target: str) -> None:
    """Give a folder a name that is not taken."""
    system, path = _path(spark, target)
    system.mkdirs(path.getParent())
    if not system.rename(_path(spark, location)[1], path):
        raise OSError(f"{location} cannot become {target}")


def read_text(spark: SparkSession, location: str) -> str:
    """A small file, whole."""
    system, path = _path(spark, location)
    stream = system.open(path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def publish_text(spark: SparkSession, text: str, location: str) -> bool:
    """Let a small file appear, whole, unless its name is taken; whether it did."""
    jvm = spark._jvm
    system, path = _path(spark, location)
    parent = path.getParent()
    prepared = jvm.org.apache.hadoop.fs.Path(parent, f".{path.getName()}-{uuid.uuid4().hex}")
    stream = system.create(prepared, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        # Unlike FileSystem.rename, this one never takes an existing file's place.
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            system.getUri(), spark._jsc.hadoopConfiguration()
        ).rename(system.makeQualified(prepared), system.makeQualified(path), options)
    except Py4JJavaError as problem:
        system.delete(prepared, False)
        if "FileAlreadyExistsException" in problem.java_exception.toString():
            return False
        raise
    return True


def modified(spark: SparkSession, location: str) -> float:
    """When a path was last changed, in seconds of the epoch."""
    system, path = _path(spark, location)
    return system.getFileStatus(path).getModificationTime() / 1000


def touch(spark: SparkSession, location: str) -> None:
    """Create an empty marker file; fails if it exists."""
    system, path = _path(spark, location)
    system.create(path, False).close()


def base_name(location: str) -> str:
    return location.rstrip("/").rsplit("/", 1)[-1]
