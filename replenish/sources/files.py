"""Small files and folders in whatever file system a path names, through Hadoop's interface."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str) -> tuple:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def _listed(spark: SparkSession, path: str, folders: bool) -> list[str]:
    place, system = _place(spark, path)
    if not system.exists(place):
        return []
    return sorted(f.getPath().getName() for f in system.listStatus(place) if f.isDirectory() == folders)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; a listing, no data is read."""
    return _listed(spark, path, folders=True)


def files_in(spark: SparkSession, path: str) -> list[str]:
    return _listed(spark, path, folders=False)


def remove(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file as a whole."""
    place, system = _place(spark, path)
    stream = system.open(place)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file that must not exist; whether it did not."""
    place, system = _place(spark, path)
    try:
        stream = system.create(place, False)
    except Py4JJavaError as failed:
        if "FileAlreadyExists" in str(failed.java_exception.getClass().getName()):
            return False
        raise
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    return True
