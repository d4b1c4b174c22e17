"""The newest (or oldest) n rows, exactly, by one plan for every size of input.

* A table at rest is visited day by day from the newest in groups of growing size, until the days together hold
  n rows of the selection.  These counts are jobs, run when the scan is built; the days beyond are never read.
* Of what is left, rows are counted per time bucket, combined in the scan tasks; only the counts of at most
  some ten thousand buckets move.  The bucket in which the n-th row lies gives a cut-off instant, a
  scalar subquery that Spark pushes into the Parquet scan at run time.  A table without days is not
  counted but read once.
* What is read is sorted in the scan tasks, and each keeps its first n rows.  It may
  still be much, when very many rows share one instant, so the kept rows of ``FAN_IN`` tasks are
  cut to n once more before the last merge.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from logframe.functions.timebounds import NANOS_PER_DAY, Window, day_of, time_filter
from logframe.model import DAY, LINE, METADATA, TS_NS, canonical_map, labels_key_of, quoted

DIRECTIONS = ("backward", "forward")

# A closed window is cut into at most 2**BUCKET_BITS buckets; an open one into buckets of 2**OPEN_SHIFT ns (73 minutes).
BUCKET_BITS = 16
OPEN_SHIFT = 42
FAN_IN = 64
#: The largest group of days that is counted by itself: beyond some years without enough rows all is read.
MOST_DAYS = 1 << 11
# Spark numbers the rows of a task in the lower 33 bits.
_ROW_BITS = (1 << 33) - 1


def check_direction(direction: str) -> str:
    lowered = str(direction).lower()
    if lowered not in DIRECTIONS:
        raise ValueError(f"unknown direction {direction!r}, expected one of {DIRECTIONS}")
    return lowered


def check_limit(limit: int | None) -> int | None:
    if limit is None:
        return None
    if isinstance(limit, bool) or not isinstance(limit, int) or limit <= 0:
        raise ValueError(f"a limit is a whole number above 0, not {limit!r}")
    return limit


def newest(
    df: DataFrame,
    n: int,
    direction: str = "backward",
    window: Window = Window(),
    tie_breakers: Iterable[str] = (),
) -> DataFrame:
    """The first n rows in time order within ``window``: newest first (``backward``) or oldest first.

    Rows of one instant are ordered by labels, line, metadata and ``tie_breakers``,
    so the result does not depend on how the data is partitioned.  Rows without a time
    and rows outside the window are not among the result.
    """
    backward = check_direction(direction) == "backward"
    check_limit(n)
    timed = in_window(df, window)
    if DAY in df.columns:
        timed = past_cut_off(days_with(timed, n, backward, window), n, backward, window)
    return first_rows(timed, n, backward, tie_breakers)


def days_with(df: DataFrame, n: int, backward: bool, window: Window = Window()) -> DataFrame:
    """The days from the newest (or oldest) on that hold ``n`` rows together, or all.

    Groups of 1, 2, 4, ... days are counted one after the other, from the end of the window that the direction names; without
    that end nothing is left out.  Each group reads what the selection needs, and no text besides.
    """
    end = window.end_ns if backward else window.start_ns
    if end is None:
        return df
    first = (end - 1 if backward else end) // NANOS_PER_DAY
    other = window.start_ns if backward else window.end_ns
    last = None if other is None else (other if backward else other - 1) // NANOS_PER_DAY
    days, found, size = 0, 0, 1
    sign = -1 if backward else 1
    while size <= MOST_DAYS and (last is None or sign * (last - first) > days):
        group = sorted((first + sign * days, first + sign * (days + size - 1)))
        found += df.where(_day_between(*group)).count()
        days, size = days + size, 2 * size
        if found >= n:
            edge = first + sign * (days - 1)
            return df.where(F.col(DAY) >= _day(edge) if backward else F.col(DAY) <= _day(edge))
    return df


def _day(number: int) -> Column:
    return F.lit(date(1970, 1, 1) + timedelta(days=number))


def _day_between(low: int, high: int) -> Column:
    return (F.col(DAY) >= _day(low)) & (F.col(DAY) <= _day(high))


def in_window(df: DataFrame, window: Window) -> DataFrame:
    """The rows that have a time, in ``window``."""
    inside = time_filter(window, df)
    return df.where(F.col(TS_NS).isNotNull() if inside is None else inside)


def first_rows(df: DataFrame, n: int, backward: bool, tie_breakers: Iterable[str] = ()) -> DataFrame:
    """Top-k in the order of :func:`newest`, cut in every task, then per group of tasks, then as a whole."""
    order = [F.col(TS_NS), labels_key_of(df), F.col(LINE)]
    if METADATA in df.columns:
        order.append(canonical_map(F.col(METADATA)))
    order += [F.col(quoted(c)) for c in tie_breakers]
    order = [c.desc() if backward else c.asc() for c in order]
    own = _cut(df, n, order).withColumn("__group", F.floor(F.spark_partition_id() / FAN_IN))
    return _cut(own.repartition("__group").drop("__group"), n, order).orderBy(*order).limit(n)


def _cut(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first n rows of every task."""
    numbered = df.sortWithinPartitions(*order).withColumn("__nth", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    return numbered.where(F.col("__nth") < n).drop("__nth")


def past_cut_off(
    df: DataFrame, n: int, backward: bool, window: Window = Window(), page: str | None = None
) -> DataFrame:
    """Rows in or past the time bucket in which the n-th row lies, or all rows if there are fewer.

    With ``page``, rows are copies that pages share.  A merged entry has at least the copies of any one
    page, so the largest page of a bucket says how many merged rows are there at least.
    """
    shift = _shift(window)
    bucket = F.shiftright(F.col(TS_NS), shift).alias("bucket")
    if page is None:
        counted = df.select(bucket).groupBy("bucket").agg(F.count("*").alias("rows"))
    else:
        per_page = df.select(bucket, F.col(quoted(page)).alias("page")).groupBy("bucket", "page").agg(F.count("*").alias("rows"))
        counted = per_page.groupBy("bucket").agg(F.max("rows").alias("rows"))
    order = F.desc("bucket") if backward else F.asc("bucket")
    reached = counted.select("bucket", F.sum("rows").over(W.orderBy(order)).alias("rows")).where(F.col("rows") >= n)
    first = F.shiftleft(reached.agg((F.max if backward else F.min)("bucket")).scalar(), shift)
    if backward:
        limit = F.coalesce(first, F.lit(-(1 << 63)))
        past = df.where(F.col(TS_NS) >= limit)
        return past.where(F.col(DAY) >= F.coalesce(day_of(first), F.lit("0001-01-01").cast("date"))) if DAY in df.columns else past
    last = first + F.lit((1 << shift) - 1)
    past = df.where(F.col(TS_NS) <= F.coalesce(last, F.lit((1 << 63) - 1)))
    return past.where(F.col(DAY) <= F.coalesce(day_of(last), F.lit("9999-12-31").cast("date"))) if DAY in df.columns else past


def _shift(window: Window) -> int:
    """The bits of a nanosecond count that lie within one bucket."""
    if window.start_ns is None or window.end_ns is None:
        return OPEN_SHIFT
    span = max(window.end_ns - window.start_ns, 1)
    return min(max(span.bit_length() - BUCKET_BITS, 0), OPEN_SHIFT)
