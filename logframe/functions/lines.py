"""Line filters as Spark columns: literal and case-sensitive, or RE2 partial matches."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F

from logframe.functions import regex
from logframe.model import LINE

LineFilter = tuple[str, str]


def _contains(line: Column, text: str) -> Column:
    return line.contains(text)


def _prefix(line: Column, text: str) -> Column:
    return line.startswith(text)


def _suffix(line: Column, text: str) -> Column:
    return line.endswith(text)


def _regex(line: Column, pattern: str) -> Column:
    java = regex.to_java(pattern)
    if not any(c in regex.SPECIAL_CHARACTERS for c in pattern):
        return line.contains(pattern)
    # Looking for plain text is much cheaper than the pattern, which needs the line decoded.
    literal = regex.required_literal(pattern)
    return line.contains(literal) & line.rlike(java) if literal else line.rlike(java)


_FILTERS = {"contains": _contains, "regex": _regex, "prefix": _prefix, "suffix": _suffix}

LINE_OPERATORS = tuple(_FILTERS) + tuple("not " + name for name in _FILTERS)


def line_filter_column(line_filter: LineFilter) -> Column:
    op, value = line_filter
    if op not in LINE_OPERATORS:
        raise ValueError(f"unknown line operator {op!r}, expected one of {LINE_OPERATORS}")
    if not isinstance(value, str):
        raise ValueError(f"invalid line filter {line_filter!r}")
    column = _FILTERS[op.removeprefix("not ")](F.col(LINE), value)
    return ~column if op.startswith("not ") else column


def line_filters_column(line_filters: Iterable[LineFilter]) -> Column | None:
    """All filters have to hold, in the given order."""
    columns = [line_filter_column(line_filter) for line_filter in line_filters]
    return reduce(and_, columns) if columns else None
