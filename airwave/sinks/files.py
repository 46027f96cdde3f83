"""Names, sizes and removal of files, through Hadoop's file system, as they may lie on any storage."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, sorted; nothing if there is no such folder."""
    files, place = _at(spark, path)
    if not files.exists(place):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(place))


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def make_folder(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.mkdirs(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds; nothing happens if it is not there."""
    files, place = _at(spark, path)
    files.delete(place, True)


def values_of(spark: SparkSession, path: str, name: str) -> list[str]:
    """The values of a folder's direct sub-folders called `name=value`, sorted as text."""
    start = f"{name}="
    return [c.removeprefix(start) for c in children(spark, path) if c.startswith(start)]
