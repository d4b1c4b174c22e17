"""Log volume over time: entries or bytes of a selection, counted over a range at every step.

At a step ``t`` counts what lies in ``(t - range, t]``.  An entry is inside from the first step at or after it up
to the last one less than ``range`` later, so entries are only counted by label set, first
step and the step after the last; each count then comes in at one step and goes out at another, and
running sums of these differences are the result.  No entry is copied into the windows that hold it, and
nothing but counts is shuffled, whatever the range.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from logframe.functions.lines import LineFilter, line_filters_column
from logframe.functions.matchers import Matcher, check_matchers, require_selector, selector_column
from logframe.functions.selector_text import read_selector
from logframe.functions.timebounds import NANOS_PER_SECOND, TimeBound, Window, explicit_window, floor_div, now_to_ns, time_filter, timedelta_to_ns, timestamp_of, with_default_hour
from logframe.model import LABELS, LABELS_KEY, LINE, TIMESTAMP, TS_NS, check_label_names, label_column, label_map_of_key, labels_key_of, promoted, quoted

VALUE = "value"
#: More steps than this are a mistake: every label set has a row for each.
MOST_STEPS = 100_000


def count_over_time(df: DataFrame, selector: str | Iterable[Matcher], **arguments) -> DataFrame:
    """Entries of a selection at every step, per label set: ``timestamp, ts_ns``, the labels, ``value``.

    ``step`` and ``range`` (default: the step) are ``timedelta``s or nanoseconds.  Steps are ``start``, ``start + step``, ... up to ``end``
    (default: the last hour), and a value counts the entries in ``(t - range, t]``.  ``by`` groups by promoted labels
    (NULL where a stream lacks one); else a label set is ``labels`` and ``labels_key``.  With ``fill`` a label set that has
    an entry anywhere has a row at every step, zeros included; without it rows of zero are left out.
    """
    return _over_time(df, selector, F.lit(1), **arguments)


def bytes_over_time(df: DataFrame, selector: str | Iterable[Matcher], **arguments) -> DataFrame:
    """Bytes of the lines of a selection at every step; arguments as for :func:`count_over_time`."""
    return _over_time(df, selector, F.octet_length(F.col(LINE)), **arguments)


def rate(df: DataFrame, selector: str | Iterable[Matcher], **arguments) -> DataFrame:
    """Entries a second over the range at every step (``value`` is a double); arguments as for :func:`count_over_time`."""
    return _per_second(count_over_time(df, selector, **arguments), **arguments)


def bytes_rate(df: DataFrame, selector: str | Iterable[Matcher], **arguments) -> DataFrame:
    """Bytes a second over the range at every step; arguments as for :func:`count_over_time`."""
    return _per_second(bytes_over_time(df, selector, **arguments), **arguments)


def _per_second(counted: DataFrame, *, step, range=None, **_) -> DataFrame:
    seconds = _span(step if range is None else range, "range") / NANOS_PER_SECOND
    return counted.withColumn(VALUE, F.col(VALUE) / F.lit(seconds))


def _span(value: timedelta | int, name: str) -> int:
    if isinstance(value, timedelta):
        value = timedelta_to_ns(value)
    if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
        raise ValueError(f"{name} must be a timedelta or nanoseconds above 0, not {value!r}")
    return value


def _over_time(
    df: DataFrame,
    selector: str | Iterable[Matcher],
    measure: Column,
    *,
    step: timedelta | int,
    range: timedelta | int | None = None,
    line: Iterable[LineFilter] = (),
    by: Sequence[str] | None = None,
    start: TimeBound | None = None,
    end: TimeBound | None = None,
    fill: bool = True,
    now: TimeBound | None = None,
) -> DataFrame:
    if isinstance(selector, str):
        selector, filters = read_selector(selector)
        line = [*filters, *line]
    matchers = check_matchers(selector)
    require_selector(matchers)
    step_ns = _span(step, "step")
    range_ns = step_ns if range is None else _span(range, "range")
    names = None if by is None else check_label_names(by)
    now_ns = now_to_ns(now)
    window = with_default_hour(explicit_window(start, end, now_ns), now_ns)
    first_ns, last = window.start_ns, (window.end_ns - window.start_ns) // step_ns
    if not 0 <= last < MOST_STEPS:
        raise ValueError(f"the window has {last + 1} steps; give an end after the start and a wider step (at most {MOST_STEPS} steps)")

    reach = Window(first_ns - range_ns + 1, first_ns + last * step_ns + 1)
    for predicate in (time_filter(reach, df), selector_column(df, matchers), line_filters_column(line)):
        if predicate is not None:
            df = df.where(predicate)
    groups = [labels_key_of(df).alias(LABELS_KEY)] if names is None else [label_column(df, name).alias(name) for name in names]
    keys = [LABELS_KEY] if names is None else [quoted(name) for name in names]

    def step_from(ns: Column) -> Column:
        """The first step at or after an instant."""
        return (floor_div(ns - F.lit(first_ns + 1), step_ns) + 1).cast("int")

    enters = F.greatest(step_from(F.col(TS_NS)), F.lit(0)).alias("enters")
    leaves = F.least(step_from(F.col(TS_NS) + F.lit(range_ns)), F.lit(last + 1)).alias("leaves")
    counts = df.select(*groups, enters, leaves, measure.cast("bigint").alias("n")).groupBy(*keys, "enters", "leaves").agg(F.sum("n").alias("n"))
    counts = counts.where("enters < leaves")  # with a range below the step an entry may be at no step
    changes = counts.select(*keys, F.inline(F.array(_change("enters", F.col("n")), _change("leaves", -F.col("n")))))
    if fill:
        grid = counts.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.lit(0), F.lit(last))).alias("step"), F.lit(0).cast("bigint").alias("change"))
        changes = changes.union(grid)
    per_step = changes.groupBy(*keys, "step").agg(F.sum("change").alias("change"))
    series = W.partitionBy(*keys).orderBy("step")
    values = per_step.select(*keys, "step", F.sum("change").over(series).alias(VALUE), F.lead("step", 1, last + 1).over(series).alias("next"))
    values = values.where(F.col("step") <= last)
    if not fill:  # a value holds until the next change
        held = F.sequence(F.col("step"), F.col("next") - 1)
        values = values.where(F.col(VALUE) != 0).select(*keys, F.explode(held).alias("step"), VALUE)
    ts_ns = F.lit(first_ns) + F.col("step").cast("bigint") * F.lit(step_ns)
    shown = [label_map_of_key(F.col(LABELS_KEY)).alias(LABELS), LABELS_KEY] if names is None else [promoted(F.col(key), name) for key, name in zip(keys, names)]
    return values.select(timestamp_of(ts_ns).alias(TIMESTAMP), ts_ns.alias(TS_NS), *shown, VALUE)


def _change(step: str, n: Column) -> Column:
    return F.struct(F.col(step).alias("step"), n.alias("change"))
