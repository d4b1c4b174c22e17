"""Nanosecond time bounds, resolved on the driver into plain integers.

Spark timestamps hold microseconds, so ``ts_ns`` (BIGINT nanoseconds since the
epoch) is what every comparison uses.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

NANOS_PER_MICRO = 1_000
NANOS_PER_SECOND = 1_000_000_000
NANOS_PER_HOUR = 3_600 * NANOS_PER_SECOND
NANOS_PER_DAY = 24 * NANOS_PER_HOUR

_EPOCH = datetime(1970, 1, 1)
_MICRO = timedelta(microseconds=1)

TimeBound = int | str | datetime | date | timedelta


def timedelta_to_ns(offset: timedelta) -> int:
    """Days count as 24 hours; microseconds are scaled and the sign is kept."""
    return (offset // _MICRO) * NANOS_PER_MICRO


def to_ns(value: TimeBound, now_ns: int) -> int:
    """Resolve one bound.

    ``int`` is taken as exact nanoseconds, a ``datetime``/``date``/ISO string as
    an instant (UTC unless it carries a zone), a ``timedelta`` as an offset
    from now.  Calendar-dependent offsets (months, years) have no
    ``timedelta`` and are refused.
    """
    if isinstance(value, bool):
        raise ValueError("a time bound must not be a boolean")
    if isinstance(value, int):
        return value
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if isinstance(value, timedelta):
        return now_ns + timedelta_to_ns(value)
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        return ((value - _EPOCH) // _MICRO) * NANOS_PER_MICRO
    if isinstance(value, date):
        return (value - _EPOCH.date()).days * NANOS_PER_DAY
    raise ValueError(
        f"{value!r} is no time bound; give nanoseconds, an instant, or a timedelta "
        "(months and years have no fixed length)"
    )


def now_to_ns(now: TimeBound | None) -> int:
    if now is None:
        return time.time_ns()
    if isinstance(now, timedelta):
        raise ValueError("now must be an absolute time")
    return to_ns(now, 0)


@dataclass(frozen=True)
class Window:
    """``[start_ns, end_ns)``: start inclusive, end exclusive; ``None`` is open."""

    start_ns: int | None = None
    end_ns: int | None = None

    def intersect(self, other: Window) -> Window:
        starts = [s for s in (self.start_ns, other.start_ns) if s is not None]
        ends = [e for e in (self.end_ns, other.end_ns) if e is not None]
        return Window(max(starts, default=None), min(ends, default=None))


def explicit_window(start: TimeBound | None, end: TimeBound | None, now: TimeBound | None = None) -> Window:
    """Only the given bounds; an omitted one stays open."""
    now_ns = now_to_ns(now)
    return Window(
        None if start is None else to_ns(start, now_ns),
        None if end is None else to_ns(end, now_ns),
    )


def with_default_hour(window: Window, now: TimeBound | None = None) -> Window:
    """Close the open sides: the end defaults to now, the start to one hour before now or an earlier end."""
    now_ns = now_to_ns(now)
    end_ns = now_ns if window.end_ns is None else window.end_ns
    start_ns = min(end_ns, now_ns) - NANOS_PER_HOUR if window.start_ns is None else window.start_ns
    return Window(start_ns, end_ns)


def window_of_predicates(predicates, now: TimeBound | None = None) -> Window:
    """Intersection of ``(op, bound)`` pairs, op one of ``>= > < <= =``."""
    now_ns = now_to_ns(now)
    window = Window()
    for op, bound in predicates:
        ns = to_ns(bound, now_ns)
        if op == ">=":
            window = window.intersect(Window(start_ns=ns))
        elif op == ">":
            window = window.intersect(Window(start_ns=ns + 1))
        elif op == "<":
            window = window.intersect(Window(end_ns=ns))
        elif op == "<=":
            window = window.intersect(Window(end_ns=ns + 1))
        elif op == "=":
            window = window.intersect(Window(ns, ns + 1))
        else:
            raise ValueError(f"unknown time operator {op!r}")
    return window


def floor_div(column: Column, width: int) -> Column:
    """Exact floor division of a BIGINT (``div`` alone truncates towards zero)."""
    width_col = F.lit(width).cast("bigint")
    return F.call_function("div", column - F.pmod(column, width_col), width_col)


def day_of(ts_ns: Column) -> Column:
    """UTC calendar day of a nanosecond instant, the partition value of log tables."""
    return F.date_from_unix_date(floor_div(ts_ns, NANOS_PER_DAY).cast("int"))


def timestamp_of(ts_ns: Column) -> Column:
    """TIMESTAMP_NTZ in UTC, floored to microseconds, whatever the session zone is."""
    micros = floor_div(ts_ns, NANOS_PER_MICRO)
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + micros * F.expr("INTERVAL '0.000001' SECOND")


def ns_of_timestamp(timestamp_ntz: Column) -> Column:
    """Nanoseconds of a UTC TIMESTAMP_NTZ, whatever the session zone is."""
    since = timestamp_ntz - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return F.call_function("div", since, F.expr("INTERVAL '0.000001' SECOND")) * F.lit(NANOS_PER_MICRO)


def _utc_day(ns: int) -> date:
    return _EPOCH.date() + timedelta(days=ns // NANOS_PER_DAY)


def _utc_literal(ns: int) -> Column:
    moment = _EPOCH + timedelta(microseconds=ns // NANOS_PER_MICRO)
    return F.expr(f"TIMESTAMP_NTZ '{moment.isoformat(sep=' ')}'")


# Schema metadata: ``timestamp`` is a stored column, which scans can prune by.
STORED_TIME = {"stored_time": True}


def counted_time(origin_ns: int, width_ns: int) -> dict[str, int]:
    """Schema metadata: the column numbers the spans of ``width_ns`` after ``origin_ns``, and ``ts_ns`` lies in that span."""
    return {"time_origin_ns": origin_ns, "time_width_ns": width_ns}


def _span_of(origin_ns: int, width_ns: int) -> Callable[[int], int]:
    return lambda ns: min(max((ns - origin_ns) // width_ns, -(1 << 63)), (1 << 63) - 1)


def _prunable(df: DataFrame) -> list[tuple[str, Callable[[int], object]]]:
    """Columns to bound besides ``ts_ns`` for the sake of pruning, and how to say a bound in them.

    Spark derives none of them from bounds on ``ts_ns``: the partition column ``day`` of a
    table at rest, or the stored column that ``ts_ns`` is computed from.
    """
    counted = [(f.name, f.metadata) for f in df.schema if "time_width_ns" in f.metadata]
    if counted:
        return [(name, _span_of(m["time_origin_ns"], m["time_width_ns"])) for name, m in counted]
    if "day" in df.columns:
        return [("day", _utc_day)]
    if "timestamp" in df.columns and df.schema["timestamp"].metadata.get("stored_time"):
        return [("timestamp", _utc_literal)]
    return []


def time_filter(window: Window, df: DataFrame) -> Column | None:
    """Predicate of ``df`` for ``window``; ``None`` for the open window."""
    terms = []
    if window.start_ns is not None:
        terms += [F.col(name) >= literal(window.start_ns) for name, literal in _prunable(df)]
        terms.append(F.col("ts_ns") >= window.start_ns)
    if window.end_ns is not None:
        terms += [F.col(name) <= literal(window.end_ns - 1) for name, literal in _prunable(df)]
        terms.append(F.col("ts_ns") < window.end_ns)
    return reduce(and_, terms) if terms else None
