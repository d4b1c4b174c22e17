"""Log tables at rest: Parquet laid out by tenant and day."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logframe.model import DAY, LABELS_KEY, TENANT, TS_NS, with_layout_columns
from logframe.sources.files import STAGED, exists, hadoop_path, move, remove, table_files

#: The folder level of a table that is kept in batches; no column of the log table.
BATCH = "batch"
COMPACTED = "compacted"
#: Bytes of a compacted file.
FILE_BYTES = 128 << 20
#: Estimated bytes in memory for a write task, and tasks beyond which an estimate is no estimate.
TASK_BYTES, MOST_TASKS = 512 << 20, 1 << 20


def partition_columns(df: DataFrame) -> list[str]:
    return [name for name in (TENANT, DAY) if name in df.columns]


def write_tasks(df: DataFrame) -> int | None:
    """Write tasks for the size that Catalyst estimates, if it wants more than the session's shuffle partitions.

    Estimates that say nothing, as after joins of large tables, are passed over.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    tasks = -(-size // TASK_BYTES)
    return tasks if int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) < tasks <= MOST_TASKS else None


def laid_out_by_time(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows ranged over tasks by tenant, day and time, streams together inside a task."""
    laid_out = with_layout_columns(df).withColumn("__spread", F.spark_partition_id())
    keys = [*partition_columns(laid_out), TS_NS, "__spread"]
    partitions = partitions or write_tasks(df)
    ranged = laid_out.repartitionByRange(*([partitions] if partitions else []), *keys).drop("__spread")
    return ranged.sortWithinPartitions(*partition_columns(ranged), LABELS_KEY, TS_NS)


def write_logs(df: DataFrame, path: str, *, mode: str = "errorifexists", partitions: int | None = None) -> None:
    """Write a log table so that scans can prune.

    Rows are ranged over tasks by tenant, day and time, so every file covers a narrow
    time span and a large day or tenant is spread over many files.  The last key is the
    task a row comes from: it lets even identical entries split, and unlike a random
    number it stays the same when a lost task is run again.  Inside a file streams lie
    together, which gives row groups with few distinct labels.  ``partitions`` is the
    number of write tasks (by default the session's shuffle partitions, more where the estimated size asks for more).
    """
    ranged = laid_out_by_time(df, partitions)
    ranged.write.mode(mode).partitionBy(*partition_columns(ranged)).parquet(path)


def land_batch(df: DataFrame, path: str, batch: str, *, partitions: int | None = None) -> None:
    """Write one batch of a log table that is kept in batches; the same batch again replaces itself.

    Each batch has a folder of its own below tenant and day, so repeating it writes nothing twice, and
    its files cover narrow time spans that overlap those of no other task of the batch.
    """
    if not re.fullmatch(r"[\w.-]+", batch) or batch == COMPACTED:
        raise ValueError(f"a batch is named by letters, digits, '.', '_' and '-', not {batch!r}")
    _land(df, path, batch, partitions)


def _land(df: DataFrame, path: str, batch: str, partitions: int | None) -> None:
    ranged = laid_out_by_time(df, partitions).withColumn(BATCH, F.lit(batch))
    writer = ranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_columns(ranged), BATCH).parquet(path)


def compact_logs(spark: SparkSession, path: str, days: Iterable[date | str] | None = None, *, least: int = 2) -> list[str]:
    """Rewrite days that have ``least`` batches or more as one batch laid out by time, and name their folders.

    The new files are written aside first.  Then the batches of a day are deleted and the new one moved to their place; a
    compaction that was interrupted there is finished by the next.  A scan that runs meanwhile may miss the files of that
    day and fail.  Streams that follow the table pass compacted files over: compact what they have seen.
    """
    finish_compaction(spark, path)
    listed = table_files(spark, path).select("unit", "size").withColumn("place", F.regexp_extract("unit", f"^(.*)/{BATCH}=[^/]*$", 1)).where("place <> ''")
    if days is not None:
        listed = listed.where(F.regexp_extract("place", f"/{DAY}=([^/]*)$", 1).isin([str(day) for day in days]))
    found = listed.groupBy("place").agg(F.countDistinct("unit").alias("units"), F.sum("size").alias("size")).where(F.col("units") >= least)
    crowded = {r.place: r.size for r in found.collect()}  # one row per day folder
    if not crowded:
        return []
    schema = read_logs(spark, path).schema
    df = spark.read.schema(schema).option("basePath", path).parquet(*crowded)
    partitions = max(1, -(-sum(crowded.values()) // FILE_BYTES))
    staged = f"{path.rstrip('/')}/{STAGED}"
    _land(df, f"{staged}/files", COMPACTED, partitions)
    spark.createDataFrame([(place,) for place in crowded], "place string").write.parquet(f"{staged}/done")
    finish_compaction(spark, path)
    return sorted(crowded)


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Put what a compaction has written aside into its place, or drop it if it is not whole."""
    staged = f"{path.rstrip('/')}/{STAGED}"
    if exists(spark, f"{staged}/done/_SUCCESS"):
        root = hadoop_path(spark, path)[0].toUri().getPath().rstrip("/")
        for row in spark.read.parquet(f"{staged}/done").collect():
            below = hadoop_path(spark, row.place)[0].toUri().getPath().removeprefix(root)
            source = f"{staged}/files{below}/{BATCH}={COMPACTED}"
            if exists(spark, source):  # else it was moved before the interruption
                remove(spark, row.place)
                move(spark, source, f"{row.place}/{BATCH}={COMPACTED}")
    if exists(spark, staged):
        remove(spark, staged)


def stored_schema(spark: SparkSession, path: str) -> T.StructType:
    """The columns of a table's files and folders; tenants stay text even where they look like numbers."""
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name in (TENANT, BATCH) else f for f in spark.read.parquet(path).schema])


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Read a log table; batches are no column of it."""
    return spark.read.schema(stored_schema(spark, path)).parquet(path).drop(BATCH)
