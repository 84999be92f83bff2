"""Small files beside the data: records written in one step, listed and removed, on any file system Spark reads."""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import SparkSession


def _path(spark: SparkSession, place: str):
    return spark._jvm.org.apache.hadoop.fs.Path(place)


def _system(spark: SparkSession, place: str):
    return _path(spark, place).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, place: str) -> bool:
    return _system(spark, place).exists(_path(spark, place))


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names of files and folders in a folder, in order; none if it is missing."""
    if not exists(spark, folder):
        return []
    return sorted(status.getPath().getName() for status in _system(spark, folder).listStatus(_path(spark, folder)))


def remove(spark: SparkSession, place: str) -> bool:
    """Remove a file, or a folder with all it holds."""
    return _system(spark, place).delete(_path(spark, place), True)


def remove_at_end(spark: SparkSession, place: str) -> None:
    """Remove a folder when the session's JVM ends in order."""
    _system(spark, place).deleteOnExit(_path(spark, place))


def read_record(spark: SparkSession, place: str) -> dict:
    stream = _system(spark, place).open(_path(spark, place))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_record(spark: SparkSession, place: str, record: dict) -> bool:
    """Write a new record; False if there is one of that name.

    It is written under another name and renamed, so that readers see all of it or nothing.
    """
    folder, _, name = place.rpartition("/")
    draft = f"{folder}/.{name}-{uuid4().hex}"
    stream = _system(spark, draft).create(_path(spark, draft), False)
    stream.write(json.dumps(record).encode())
    stream.close()
    if exists(spark, place):
        remove(spark, draft)
        return False
    options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    source, target = _path(spark, draft), _path(spark, place)
    target = target.makeQualified(_system(spark, place).getUri(), target)
    source = source.makeQualified(_system(spark, place).getUri(), source)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(source, target, options)
    except Exception as error:  # somebody else was first
        remove(spark, draft)
        if "FileAlreadyExists" in str(error) and not isinstance(error, PySparkException):
            return False
        raise
    return True


def part_name(spark: SparkSession, value: str) -> str:
    """A value as Spark writes it into the name of a partition's folder."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
