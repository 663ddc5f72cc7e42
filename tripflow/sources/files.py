"""What lies at a path, asked of the file system that Spark reads it from."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def is_folder(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place) and system.getFileStatus(place).isDirectory()


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether the path is a file, or a folder with a file that Spark would read.

    A folder that a stream writes to counts from its first committed batch on.
    """
    system, place = _place(spark, path)
    if not system.exists(place):
        return False
    if not system.getFileStatus(place).isDirectory():
        return True
    names = [status.getPath().getName() for status in system.listStatus(place)]
    if "_spark_metadata" in names:
        log = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_spark_metadata")
        commits = (status.getPath().getName() for status in system.listStatus(log))
        return any(name.split(".")[0].isdigit() for name in commits)
    return any(
        has_data(spark, f"{path}/{name}") for name in names if not name.startswith(("_", "."))
    )


def remove(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.delete(place, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return []
    return [status.getPath().getName() for status in system.listStatus(place)]


def folder_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a partition column for which a table has a folder."""
    start = f"{column}="
    return [name.removeprefix(start) for name in file_names(spark, path) if name.startswith(start)]
