"""Log scans: a selection of entries from a log table.

The arguments of a scan are applied first, then the limit; a ``where`` chained
onto the result sees only the limited rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from logframe.functions.lines import LineFilter, line_filters_column
from logframe.functions.matchers import (
    Matcher,
    check_label_predicates,
    check_matchers,
    label_predicate_column,
    matcher_column,
    predicate_as_matcher,
    require_selector,
    selector_column,
)
from logframe.functions.selector_text import read_selector
from logframe.functions.timebounds import (
    TimeBound,
    Window,
    explicit_window,
    now_to_ns,
    time_filter,
    window_of_predicates,
    with_default_hour,
)
from logframe.model import (
    LABELS,
    LINE,
    METADATA,
    TIMESTAMP,
    TS_NS,
    check_label_names,
    empty_map,
    label_column,
    promoted,
    quoted,
)
from logframe.operators.topk import check_direction, check_limit, newest

DEFAULT_LIMIT = 5000


def scan_logs(
    df: DataFrame,
    selector: str | Iterable[Matcher],
    *,
    line: Iterable[LineFilter] = (),
    labels: Sequence[str] = (),
    start: TimeBound | None = None,
    end: TimeBound | None = None,
    limit: int | None = DEFAULT_LIMIT,
    direction: str = "backward",
    keep: Sequence[str] = (),
    now: TimeBound | None = None,
) -> DataFrame:
    """Entries of one selection.

    ``selector`` is a list of ``(label, op, value)`` matchers, or text such as
    ``{job="api"} |= "timeout"`` whose line filters come before those of ``line``, and must
    demand at least one non-empty label.  ``start``/``end`` bound the scan (start inclusive,
    end exclusive) and default to the last hour.  ``limit`` is the total number of
    rows, newest first (``direction='backward'``) or oldest first (``'forward'``);
    ``None`` returns the whole selection, in no order.  ``labels`` are promoted to
    columns; ``keep`` passes other columns of ``df`` through.
    """
    if selector is None:
        raise ValueError("a scan needs a selector: a list of matchers, or text such as {job=\"api\"}")
    selector, line = _read(selector, line)
    matchers = check_matchers(selector)
    require_selector(matchers)
    names = check_label_names(labels)
    check_limit(limit)
    direction = check_direction(direction)
    now_ns = now_to_ns(now)
    window = with_default_hour(explicit_window(start, end, now_ns), now_ns)
    selected = _select(df, matchers, line, window)
    return _finish(selected, names, keep, limit, direction, window)


def refine_logs(
    df: DataFrame,
    selector: str | Iterable[Matcher] = (),
    *,
    label_where: Iterable[tuple] = (),
    time_where: Iterable[tuple[str, TimeBound]] = (),
    line: Iterable[LineFilter] = (),
    labels: Sequence[str] = (),
    start: TimeBound | None = None,
    end: TimeBound | None = None,
    limit: int | None = DEFAULT_LIMIT,
    direction: str = "backward",
    keep: Sequence[str] = (),
    now: TimeBound | None = None,
) -> DataFrame:
    """A base selector refined by SQL-like predicates.

    ``label_where`` holds ``(label, op, value)`` on promoted labels with op ``=``,
    ``!=`` or ``in`` (SQL semantics: a missing label drops out); an ``=`` or ``in``
    can stand in for the selector.  ``time_where`` holds ``(op, bound)``; it replaces
    the default window and intersects with explicit ``start``/``end``.

    ``!=`` narrows the scan the way a selector does, keeping entries that lack the
    label, and drops those only after the limit.
    """
    selector, line = _read(selector, line)
    matchers = check_matchers(selector)
    names = check_label_names(labels)
    predicates = check_label_predicates(label_where, names)
    require_selector([*matchers, *map(predicate_as_matcher, predicates)])
    check_limit(limit)
    direction = check_direction(direction)
    now_ns = now_to_ns(now)
    window = explicit_window(start, end, now_ns).intersect(window_of_predicates(time_where, now_ns))
    window = with_default_hour(window, now_ns)
    selected = _select(df, matchers, line, window)
    for predicate in predicates:
        if predicate[1] == "!=":
            selected = selected.where(matcher_column(df, predicate))
        else:
            selected = selected.where(label_predicate_column(df, predicate))
    result = _finish(selected, names, keep, limit, direction, window)
    for label, op, value in predicates:
        if op == "!=":
            result = result.where(F.col(quoted(label)) != value)
    return result


def _read(selector: str | Iterable[Matcher], line: Iterable[LineFilter]):
    """The matchers and line filters, whether given as text or as lists."""
    if not isinstance(selector, str):
        return selector, line
    matchers, filters = read_selector(selector)
    return matchers, [*filters, *line]


def _select(df: DataFrame, matchers, line, window: Window) -> DataFrame:
    for predicate in (
        time_filter(window, df),
        selector_column(df, matchers),
        line_filters_column(line),
    ):
        if predicate is not None:
            df = df.where(predicate)
    return df


def _finish(selected: DataFrame, labels, keep, limit, direction, window: Window) -> DataFrame:
    if limit is not None:
        selected = newest(selected, limit, direction, window, tie_breakers=keep)
    metadata = F.coalesce(F.col(METADATA), empty_map()) if METADATA in selected.columns else empty_map()
    return selected.select(
        TIMESTAMP,
        TS_NS,
        LINE,
        *(promoted(label_column(selected, name), name) for name in labels),
        LABELS,
        metadata.alias(METADATA),
        *(F.col(quoted(name)) for name in keep),
    )
