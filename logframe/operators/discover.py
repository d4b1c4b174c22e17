"""Discovery: which labels, values and series a log table holds.

Omitted time bounds mean the whole table.  Everything here reduces rows to
distinct values in the scan tasks before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from logframe.functions.matchers import Matcher, check_matchers, require_selector, selector_column
from logframe.functions.timebounds import TimeBound, explicit_window, time_filter
from logframe.model import (
    LABELS,
    LABELS_KEY,
    check_label_names,
    label_column,
    label_map_of_key,
    labels_key_of,
    quoted,
)


def _restrict(df: DataFrame, matchers, start, end, now) -> DataFrame:
    for predicate in (
        time_filter(explicit_window(start, end, now), df),
        selector_column(df, matchers),
    ):
        if predicate is not None:
            df = df.where(predicate)
    return df


def label_names(
    df: DataFrame,
    *,
    start: TimeBound | None = None,
    end: TimeBound | None = None,
    now: TimeBound | None = None,
) -> DataFrame:
    """Distinct label names, one per row, as ``label``."""
    name_sets = _restrict(df, (), start, end, now).select(F.map_keys(LABELS).alias("names")).distinct()
    # The outer form: a plain explode would test every row of the scan for emptiness first.
    names = name_sets.select(F.explode_outer("names").alias("label"))
    return names.where(F.col("label").isNotNull()).distinct()


def label_values(
    df: DataFrame,
    name: str,
    *,
    selector: Iterable[Matcher] = (),
    start: TimeBound | None = None,
    end: TimeBound | None = None,
    now: TimeBound | None = None,
) -> DataFrame:
    """Distinct values of one label as ``value``; a selector narrows the contributing series."""
    if not isinstance(name, str) or not name:
        raise ValueError("a label name is required")
    restricted = _restrict(df, check_matchers(selector), start, end, now)
    values = restricted.select(label_column(df, name).alias("value"))
    return values.where(F.col("value").isNotNull()).distinct()


def series(
    df: DataFrame,
    selector: Iterable[Matcher],
    *,
    labels: Sequence[str] = (),
    start: TimeBound | None = None,
    end: TimeBound | None = None,
    now: TimeBound | None = None,
) -> DataFrame:
    """Distinct label sets matching a selector: promoted ``labels`` columns, then the map."""
    if selector is None:
        raise ValueError("series needs a stream selector")
    matchers = check_matchers(selector)
    require_selector(matchers)
    return series_of(_restrict(df, matchers, start, end, now), labels)


def series_of(df: DataFrame, labels: Sequence[str] = ()) -> DataFrame:
    """Distinct label sets of a log table.

    Promoted labels depend on the label set alone.  They are grouped by as well, so
    that a filter on them passes through to the scan.
    """
    promoted = check_label_names(labels)
    values = [label_column(df, name).alias(name) for name in promoted]
    distinct_sets = df.select(labels_key_of(df).alias(LABELS_KEY), *values).distinct()
    return distinct_sets.select(
        *(F.col(quoted(name)) for name in promoted),
        label_map_of_key(F.col(LABELS_KEY)).alias(LABELS),
    )
