"""What the operators of this subpackage share: intermediate tables, batches, text columns."""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import shutil
import site
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: bytes.translate table that lower-cases A-Z and leaves every other byte.
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: The tables written since the innermost ``scratch`` began.
made: list[str] = []


def with_package(spark: SparkSession) -> SparkSession:
    """``spark`` with this package at hand in the Python workers.

    They find it by themselves where it is installed, on PYTHONPATH, or in the working folder. Elsewhere
    Spark sends it to them as a zip file, as ``--py-files`` would.
    """
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    found = [os.getcwd(), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep)), *site.getsitepackages()]
    if root not in map(os.path.realpath, found) and not any(f.endswith("/logframe.zip") for f in spark.sparkContext.listFiles):
        folder = os.path.realpath(tempfile.mkdtemp(prefix="logframe-"))
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/logframe", "zip", root, os.path.basename(package)))
    return spark


def mapped(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``df`` through ``function`` in Python workers that have this package: every operator's only way to them."""
    with_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a session in one process that names none gets a temporary folder, for as long as the process lives.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="logframe-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        folder = "file://" + own
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` computed once into the shared folder and read back, and where it lies.

    The copy cuts the lineage, survives the loss of executors, and tells the planner its size.
    """
    path = shared_path(df.sparkSession, name)
    made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once into the shared folder and read back."""
    return written_at(df, name)[0]


def removed(spark: SparkSession, *paths: str) -> None:
    """Delete tables that ``written`` made, once nothing reads them any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables written inside when it ends.  What is read after it must lie elsewhere."""
    before, made[:] = list(made), []
    try:
        yield
    finally:
        removed(spark, *made)
        made[:] = before


def ranked(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``rank``, from 0 within its ``tree`` in the given order, and ``count``, the tree's rows.

    Rows are sorted by ranges, so a tree of any size is dealt over many tasks; a row's rank is its
    place among its tree's rows in its task and the number of those in tasks before.
    """
    dealt = df.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    dealt = dealt.withColumn("task", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    dealt = written(dealt, "ordered")
    parts = dealt.groupBy("tree", "task").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(tree.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("tree", "task", (before - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("count"))
    return dealt.join(parts, ["tree", "task"]).withColumn("rank", F.col("at") + F.col("shift")).drop("at", "task", "shift")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def text_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """The first two columns of each batch as lists, in slices of bounded text."""
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        size = max(1, texts.nbytes)
        step = max(1, int(len(texts) * min(1.0, (8 << 20) / size))) if len(texts) else 1
        for at in range(0, len(texts), step):
            yield ids.slice(at, step).to_pylist(), texts.slice(at, step).to_pylist()


def runs(*columns: np.ndarray) -> np.ndarray:
    """Start of every run of equal rows, and the number of rows at the end."""
    n = len(columns[0])
    if not n:
        return np.zeros(1, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.append(np.flatnonzero(new), n)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: int, least: int = 1 << 16) -> Iterator[pa.Table]:
    """Rows that come sorted by their first ``keys`` columns, in tables that split no group."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        data = pa.Table.from_batches(held)
        starts = runs(*(data.column(i).to_numpy() for i in range(keys)))
        cut = int(starts[-2])  # the last group may go on
        if cut:
            yield data.slice(0, cut)
        held = data.slice(cut).combine_chunks().to_batches()
        rows = data.num_rows - cut
        least = max(least, 2 * rows) if not cut else least
    if rows:
        yield pa.Table.from_batches(held)
