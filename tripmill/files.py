"""Small files and folders wherever Spark reaches, without a Spark job. The one module that asks Spark's JVM for anything."""

import uuid

from pyspark.sql import SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """The paths of folders that fit a pattern with ``*``, each as the file system names it, in order."""
    system, place = _at(spark, pattern)
    found = system.globStatus(place)
    return sorted(status.getPath().toString() for status in found or [] if status.isDirectory())


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names of all that lies in a folder, in order; none where there is no folder."""
    system, place = _at(spark, folder)
    return sorted(status.getPath().getName() for status in system.listStatus(place)) if system.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a file, none where there is no file."""
    system, place = _at(spark, path)
    if not system.exists(place) or system.getFileStatus(place).isDirectory():
        return None
    stream = system.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file whole or not at all: under a new name, which then replaces the file of that name, if there is one."""
    jvm = spark.sparkContext._jvm
    folder, name = path.rstrip("/").rsplit("/", 1)
    system, new = _at(spark, f"{folder}/_{name.lstrip('_')}.{uuid.uuid4().hex}")
    stream = system.create(new)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.valueOf("OVERWRITE")
    context.rename(system.makeQualified(new), system.makeQualified(_path(spark, path)), options)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or a folder with all that is in it; false where there is none."""
    system, place = _at(spark, path)
    return system.delete(place, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, so that two names of one place are equal."""
    system, place = _at(spark, path)
    return system.makeQualified(place).toString().rstrip("/")


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _at(spark: SparkSession, path: str):
    place = _path(spark, path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place
