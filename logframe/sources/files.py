"""The files of a table at rest, seen through Spark's own listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Folders that begin with an underscore are no part of the table for Spark's readers.
SERIES_INDEX, TEXT_INDEX, STAGED = "_series", "_grams", "_staged"


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = hadoop_path(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    place, system = hadoop_path(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; the folders above its new place are made."""
    place, system = hadoop_path(spark, path)
    target, _ = hadoop_path(spark, to)
    system.mkdirs(target.getParent())
    if not system.rename(place, target):
        raise OSError(f"cannot move {path} to {to}")


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, unit, size``: every Parquet file of a table and its folder, as paths; no content is read.

    The listing is a Spark job, so folders of many files are listed by many tasks.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return listed.select(F.col("path").alias("file"), F.regexp_replace("path", "/[^/]*$", "").alias("unit"), F.col("length").alias("size"))


def units(spark: SparkSession, path: str) -> DataFrame:
    """``unit, print``: the folders of a table, and a number that changes with their files."""
    listed = table_files(spark, path).groupBy("unit").agg(F.array_sort(F.collect_list(F.struct("file", "size"))).alias("files"))
    return listed.select("unit", F.xxhash64("files").alias("print"))
