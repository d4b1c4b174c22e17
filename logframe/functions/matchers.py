"""Stream selectors and label predicates as Spark columns.

A selector is a list of matchers ``(label, op, value)`` with op one of ``=``,
``!=``, ``=~``, ``!~``.  For selectors a missing label equals the empty string.
Label predicates, by contrast, follow SQL: a missing label is NULL and drops out.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from logframe.functions import regex
from logframe.model import label_column

Matcher = tuple[str, str, str]

SELECTOR_OPERATORS = ("=", "!=", "=~", "!~")
LABEL_PREDICATE_OPERATORS = ("=", "!=", "in")


def check_matchers(matchers: Iterable[Matcher]) -> list[Matcher]:
    checked = []
    for matcher in matchers:
        label, op, value = matcher
        if op not in SELECTOR_OPERATORS:
            raise ValueError(f"unknown selector operator {op!r}, expected one of {SELECTOR_OPERATORS}")
        if not isinstance(label, str) or not label or not isinstance(value, str):
            raise ValueError(f"invalid matcher {matcher!r}")
        checked.append((label, op, value))
    return checked


def selects_something(matchers: Iterable[Matcher]) -> bool:
    """Whether some ``=`` or ``=~`` matcher demands a non-empty label."""
    for _, op, value in matchers:
        if op == "=" and value != "":
            return True
        if op == "=~" and not regex.matches_empty(value):
            return True
    return False


def require_selector(matchers: Sequence[Matcher]) -> None:
    if not selects_something(matchers):
        raise ValueError(
            "a stream selector is required: give at least one '=' or '=~' matcher "
            "(or '='/'in' label predicate) that does not accept the empty string"
        )


def matcher_column(df: DataFrame, matcher: Matcher) -> Column:
    label, op, value = matcher
    column = label_column(df, label)
    if op == "=":
        # The plain comparison is what Parquet can prune with.
        return column == value if value != "" else F.coalesce(column, F.lit("")) == ""
    if op == "!=":
        return column.isNull() | (column != value) if value != "" else column != ""
    matched = _anchored_match(column, value)
    return matched if op == "=~" else ~matched


def _anchored_match(column: Column, pattern: str) -> Column:
    """Full match of a label; never NULL.

    Where a missing label cannot match, that is said first, along with what a plain
    comparison can tell, for the scan to prune by.
    """
    java = regex.to_java_anchored(pattern)
    alternatives = regex.literal_alternatives(pattern)
    if regex.matches_empty(pattern):
        text = F.coalesce(column, F.lit(""))
        return text.isin(alternatives) if alternatives is not None else text.rlike(java)
    if alternatives is not None:
        return column.isNotNull() & column.isin(alternatives)
    prefix = regex.literal_prefix(pattern)
    present = column.isNotNull() & column.startswith(prefix) if prefix else column.isNotNull()
    return present & column.rlike(java)


def selector_column(df: DataFrame, matchers: Iterable[Matcher]) -> Column | None:
    """All matchers have to hold, in the given order."""
    columns = [matcher_column(df, matcher) for matcher in matchers]
    return reduce(and_, columns) if columns else None


def predicate_as_matcher(predicate) -> Matcher:
    """The selector matcher that a label predicate implies."""
    label, op, value = predicate
    if op == "in":
        return label, "=~", "|".join(regex.escape_literal(v) for v in value)
    return label, op, value


def check_label_predicates(predicates, labels: Sequence[str]):
    checked = []
    for predicate in predicates:
        label, op, value = predicate
        if op not in LABEL_PREDICATE_OPERATORS:
            raise ValueError(f"unknown label operator {op!r}, expected one of {LABEL_PREDICATE_OPERATORS}")
        if label not in labels:
            raise ValueError(f"label {label!r} is used in a predicate but not promoted")
        if op == "in":
            value = list(value)
            if not value or any(not isinstance(v, str) for v in value):
                raise ValueError("an 'in' predicate needs a non-empty list of strings")
        elif not isinstance(value, str):
            raise ValueError(f"invalid label predicate {predicate!r}")
        checked.append((label, op, value))
    return checked


def label_predicate_column(df: DataFrame, predicate) -> Column:
    """SQL semantics: a missing label is NULL."""
    label, op, value = predicate
    column = label_column(df, label)
    if op == "in":
        return column.isin(value)
    return column == value if op == "=" else column != value
