"""The few calls that go to the file system of a path itself: names of folders, an exclusive rename, removal."""

from __future__ import annotations

import datetime as dt

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _opened(spark, path)
    return system.exists(place)


def children(spark: SparkSession, path: str) -> dict[str, dt.datetime]:
    """Names below a folder with the times of their last change (UTC); none if there is no folder."""
    system, place = _opened(spark, path)
    if not system.exists(place):
        return {}
    found = system.listStatus(place)
    return {
        one.getPath().getName(): dt.datetime.fromtimestamp(one.getModificationTime() / 1000, dt.timezone.utc) for one in found
    }


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Paths, relative to ``path``, of the partition folders that many levels below."""
    found = [""]
    for _ in range(depth):
        found = [f"{at}{name}/" for at in found for name in children(spark, f"{path}/{at}") if "=" in name]
    return [at.rstrip("/") for at in found]


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Give ``source`` the name ``target`` unless that exists; False if it does."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    place = hadoop.Path(target)
    context = hadoop.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(hadoop.Path(source), place, options)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def remove(spark: SparkSession, path: str) -> None:
    system, place = _opened(spark, path)
    system.delete(place, True)
