from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from logframe.functions.lines import LineFilter
from logframe.functions.matchers import Matcher
from logframe.functions.timebounds import NANOS_PER_HOUR, TimeBound, Window, now_to_ns, to_ns
from logframe.model import TENANT, check_label_names
from logframe.operators.scan import DEFAULT_LIMIT, scan_logs
from logframe.operators.topk import check_direction, check_limit, first_rows
from logframe.sources.files import exists
from logframe.sources.payload import parse_streams, payload_rejects
from logframe.sources.series_index import refresh_index
from logframe.sources.tables import BATCH, COMPACTED, land_batch, stored_schema


def payload_stream(spark: SparkSession, path: str, *, files_per_batch: int | None = None) -> DataFrame:
    """Captured payload files as they arrive: ``path`` and ``body``."""
    reader = spark.readStream.format("text").option("wholetext", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def log_stream(spark: SparkSession, path: str) -> DataFrame:
    """A log table at rest as a stream of its new entries.

    A scan without a limit consists of filters and columns only, so
    ``scan_logs(log_stream(...), ..., limit=None)`` works unchanged.  Files of a compaction hold nothing new.
    """
    stream = spark.readStream.schema(stored_schema(spark, path)).parquet(path)
    return stream.where(F.col(BATCH) != COMPACTED).drop(BATCH) if BATCH in stream.columns else stream


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """A folder for the progress of a stream, below the shared folder the session names."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("pass checkpoint=, or set spark.checkpoint.dir to a shared folder")
    return f"{shared.rstrip('/')}/{name}"


def ingest_payloads(
    payloads: DataFrame,
    path: str,
    *,
    name: str,
    checkpoint: str | None = None,
    rejects: str | None = None,
    once: bool = True,
    partitions: int | None = None,
) -> StreamingQuery:
    """Parse a stream of stream payloads and land it in a log table, each payload exactly once.

    Every micro-batch becomes one batch of the table (:func:`land_batch`), laid out by time, below its days (and its
    ``tenant`` where ``payloads`` has that column), and its label sets go into the side table.  Batches are named by the
    stream's own id and their number, so a batch that is run again after a failure replaces what it had written.
    ``once`` stops when everything that has arrived is written.  An invalid payload fails the query, unless
    ``rejects`` names a folder: the same batch then lists it there before it lands the others, so none is
    lost as long as the query goes on.
    """
    spark = payloads.sparkSession
    place = checkpoint or checkpoint_location(spark, name)
    keep = (TENANT,) if TENANT in payloads.columns else ()
    ids: list[str] = []

    def land(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        if not ids:
            ids.append(stream_id(session, place))
        own = f"{ids[0]}-{number}"
        batch = batch.persist()
        try:
            if rejects is not None:
                refused = payload_rejects(batch).withColumn(BATCH, F.lit(own)).coalesce(1)
                refused.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).json(rejects)
            land_batch(parse_streams(batch, on_invalid="fail" if rejects is None else "skip", keep=keep), path, own, partitions=partitions)
            if exists(session, path):
                refresh_index(session, path)
        finally:
            batch.unpersist()

    writer = payloads.writeStream.foreachBatch(land).queryName(name).option("checkpointLocation", place)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint over all its runs."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def tail_logs(
    logs: DataFrame,
    selector: str | Iterable[Matcher],
    each: Callable[[DataFrame, int], None],
    *,
    name: str,
    line: Iterable[LineFilter] = (),
    labels: Sequence[str] = (),
    limit: int | None = DEFAULT_LIMIT,
    direction: str = "backward",
    start: TimeBound | None = None,
    keep: Sequence[str] = (),
    checkpoint: str | None = None,
    every: str | None = None,
    now: TimeBound | None = None,
) -> StreamingQuery:
    """Follow a selection of a :func:`log_stream` as entries arrive.

    ``each(entries, number)`` gets what a trigger brings: the rows of :func:`scan_logs`, at most ``limit`` of them, newest or
    oldest first.  Entries before ``start`` (default: an hour before now) are passed over.  The query goes on
    where it stopped, from its checkpoint; ``each`` may see a batch again that it failed in.  ``every`` is the
    trigger's interval; without it the query stops when everything that has arrived was seen.
    """
    if not logs.isStreaming:
        raise ValueError("tail_logs follows a stream; make one with log_stream")
    names = check_label_names(labels)
    check_limit(limit)
    direction = check_direction(direction)
    now_ns = now_to_ns(now)
    window = Window((now_ns - NANOS_PER_HOUR) if start is None else to_ns(start, now_ns), (1 << 63) - 1)
    selected = scan_logs(logs, selector, line=line, start=window.start_ns, end=window.end_ns, limit=None, labels=names, keep=keep)

    def show(batch: DataFrame, number: int) -> None:
        each(batch if limit is None else first_rows(batch, limit, direction == "backward", keep), number)

    writer = selected.writeStream.foreachBatch(show).queryName(name).option("checkpointLocation", checkpoint or checkpoint_location(logs.sparkSession, name))
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()
