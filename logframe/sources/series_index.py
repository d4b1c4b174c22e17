"""The side table of a log table at rest: which label sets each folder holds, how many entries, between which instants.

It lies in the folder ``_series`` of the table, which readers of the table pass over.  Rows belong to a folder
of the table and to a number drawn from that folder's files.  Only rows whose number is that of
the folder now count, so nothing has to be taken back: a batch that is lost, repeated, compacted or deleted changes
the number of its folders, and folders without valid rows are read themselves until :func:`refresh_index` adds their rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from logframe.functions.timebounds import TimeBound, Window, explicit_window, time_filter
from logframe.model import DAY, LABELS, LABELS_KEY, STREAM_ID, TENANT, TS_NS, label_map_of_key, labels_key_of, stream_id_of
from logframe.sources.files import SERIES_INDEX, exists, remove, units
from logframe.sources.tables import read_logs, stored_schema

COLUMNS = (TENANT, DAY, LABELS_KEY, STREAM_ID, "entries", "first_ns", "last_ns")
SCHEMA = f"unit string, print bigint, {TENANT} string, {DAY} date, {LABELS_KEY} string, {STREAM_ID} bigint, entries bigint, first_ns bigint, last_ns bigint"


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}/{SERIES_INDEX}"


def has_index(spark: SparkSession, path: str) -> bool:
    return exists(spark, index_path(path))


def counted_series(df: DataFrame, *keys: str) -> DataFrame:
    """The rows of the side table for a log table: one per tenant, day and label set, combined in the scan tasks."""
    own = [F.col(name) if name in df.columns else F.lit(None).cast(kind).alias(name) for name, kind in ((TENANT, "string"), (DAY, "date"))]
    rows = df.select(*keys, *own, labels_key_of(df).alias(LABELS_KEY), TS_NS)
    found = rows.groupBy(*keys, TENANT, DAY, LABELS_KEY).agg(F.count("*").alias("entries"), F.min(TS_NS).alias("first_ns"), F.max(TS_NS).alias("last_ns"))
    return found.select(*keys, TENANT, DAY, LABELS_KEY, stream_id_of(F.col(LABELS_KEY)).alias(STREAM_ID), "entries", "first_ns", "last_ns")


def valid_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the side table that hold for the folders as they are."""
    if not has_index(spark, path):
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).parquet(index_path(path))
    return rows.join(units(spark, path), ["unit", "print"], "left_semi").distinct()


def stale_units(spark: SparkSession, path: str) -> list[str]:
    """The folders that the side table does not cover: after every landed batch none, so they are a list of paths."""
    current = units(spark, path)
    if has_index(spark, path):
        current = current.join(spark.read.schema(SCHEMA).parquet(index_path(path)).select("unit", "print").distinct(), ["unit", "print"], "left_anti")
    return sorted(r.unit for r in current.select("unit").collect())


def read_units(spark: SparkSession, path: str, found: list[str]) -> DataFrame:
    """The entries of some folders of a table."""
    return spark.read.schema(stored_schema(spark, path)).option("basePath", path).parquet(*found)


def refresh_index(spark: SparkSession, path: str, *, rebuild: bool = False) -> list[str]:
    """Add the rows of the folders that the side table does not cover, and name these folders.

    Only they are read.  ``rebuild`` drops all rows first, those of folders that are no more included.
    """
    if rebuild:
        remove(spark, index_path(path))
    found = stale_units(spark, path)
    if found:
        df = read_units(spark, path, found)
        files = counted_series(df.withColumn("file", F.col("_metadata.file_path")), "file")
        unit = F.regexp_replace("file", "/[^/]*$", "").alias("unit")  # of a file, not of each of its entries
        merged = files.groupBy(unit, TENANT, DAY, LABELS_KEY, STREAM_ID)
        rows = merged.agg(F.sum("entries").alias("entries"), F.min("first_ns").alias("first_ns"), F.max("last_ns").alias("last_ns"))
        rows = rows.join(units(spark, path), "unit").select("unit", "print", *COLUMNS)
        rows.write.mode("append").parquet(index_path(path))
    return found


def indexed_series(
    spark: SparkSession,
    path: str,
    *,
    start: TimeBound | None = None,
    end: TimeBound | None = None,
    now: TimeBound | None = None,
    tenants: Iterable[str] = (),
) -> DataFrame:
    """The label sets of a table at rest with an entry in the window, from its side table.

    ``tenant, day, labels_key, stream_id, entries, first_ns, last_ns, labels``: one row per tenant, day, folder and label set, of
    which the counts and instants are those of the whole day.  Discovery functions take it in
    place of the log table.  The log table is read only where the window cuts through a day's entries
    of a label set, and where the side table does not cover a folder.
    """
    window = explicit_window(start, end, now)
    rows = valid_rows(spark, path).drop("unit", "print")
    stale = stale_units(spark, path)
    if stale:
        rows = rows.union(counted_series(read_units(spark, path, stale)))
    if list(tenants):
        rows = rows.where(F.col(TENANT).isin(list(tenants)))
    return in_window(rows, read_logs(spark, path), window).withColumn(LABELS, label_map_of_key(F.col(LABELS_KEY)))


def in_window(rows: DataFrame, logs: DataFrame, window: Window) -> DataFrame:
    """The rows with an entry in the window.

    The first and the last instant are entries.  Only where these lie on either side of the window, which then is
    within a day, the entries of that day say whether one lies between.
    """
    if window == Window():
        return rows
    after = F.lit(True) if window.start_ns is None else F.col("first_ns") >= window.start_ns
    ends_after = F.lit(True) if window.start_ns is None else F.col("last_ns") >= window.start_ns
    before = F.lit(True) if window.end_ns is None else F.col("first_ns") < window.end_ns
    ends_before = F.lit(True) if window.end_ns is None else F.col("last_ns") < window.end_ns
    sure = rows.where((after & before) | (ends_after & ends_before))
    around = rows.where(~after & ~ends_before)
    if window.start_ns is None or window.end_ns is None or around.isEmpty():
        return sure
    some = logs.where(time_filter(window, logs))
    keys = [name for name in (TENANT, DAY) if name in logs.columns]
    some = some.select(*keys, labels_key_of(logs).alias(LABELS_KEY)).distinct()
    return sure.union(around.join(some, [*keys, LABELS_KEY], "left_semi").select(sure.columns))
