"""Scans of a log table at rest through its side tables.

A selector is a matter of label sets, of which a table has far fewer than entries.  It is evaluated on the side
table of label sets once, and entries are then chosen by the number of their set alone: no pattern is
matched and no map opened for an entry.  Line filters choose files by the text index first.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from logframe.functions.lines import LineFilter, line_filters_column
from logframe.functions.matchers import Matcher, check_matchers, require_selector, selector_column
from logframe.functions.timebounds import TimeBound, explicit_window, now_to_ns, time_filter, with_default_hour
from logframe.model import LABELS, LABELS_KEY, STREAM_ID, TENANT, check_label_names, labels_key_of, quoted, stream_id_of
from logframe.operators.scan import DEFAULT_LIMIT, _finish, _read
from logframe.operators.topk import check_direction, check_limit
from logframe.sources.series_index import has_index, indexed_series
from logframe.sources.tables import BATCH, read_logs, stored_schema
from logframe.sources.text_index import files_with, literals_of

ALL_LABELS = "*"
#: So many numbers of label sets are written into the scan, where Parquet prunes by them; more are joined.
LISTED = 1000


def scan_table(
    spark: SparkSession,
    path: str,
    selector: str | Iterable[Matcher],
    *,
    line: Iterable[LineFilter] = (),
    labels: str | Sequence[str] = (),
    start: TimeBound | None = None,
    end: TimeBound | None = None,
    limit: int | None = DEFAULT_LIMIT,
    direction: str = "backward",
    tenant: str | None = None,
    keep: Sequence[str] = (),
    now: TimeBound | None = None,
) -> DataFrame:
    """The rows of :func:`scan_logs` over a table at rest that has a side table of label sets.

    Building the scan runs small jobs: the matching label sets are looked up in the side table, files in the text index if there
    is one, and days are counted if there is a limit.  ``labels="*"`` promotes every label that a
    matching label set of the window has, in the order of their names.  ``tenant`` reads one tenant alone.
    """
    if selector is None:
        raise ValueError("a scan needs a selector: a list of matchers, or text such as {job=\"api\"}")
    selector, line = _read(selector, line)
    line = list(line)
    matchers = check_matchers(selector)
    require_selector(matchers)
    names = None if labels == ALL_LABELS else check_label_names(labels)
    check_limit(limit)
    direction = check_direction(direction)
    filters = line_filters_column(line)
    if not has_index(spark, path):
        raise ValueError(f"{path} has no side table of label sets; make one with refresh_index")
    now_ns = now_to_ns(now)
    window = with_default_hour(explicit_window(start, end, now_ns), now_ns)

    known = indexed_series(spark, path, start=window.start_ns, end=window.end_ns, tenants=[] if tenant is None else [tenant])
    chosen = known.where(selector_column(known, matchers)).select(STREAM_ID, LABELS_KEY).distinct()
    found = chosen.limit(LISTED + 1).collect()
    if names is None:
        every = known.join(chosen, [STREAM_ID, LABELS_KEY], "left_semi").select(F.explode(F.map_keys(LABELS)).alias("label")).distinct()
        names = check_label_names(sorted(r.label for r in every.collect()))  # they become columns: their number is that of a schema

    df = _entries(spark, path, files_with(spark, path, literals_of(line)))
    if tenant is not None:
        df = df.where(F.col(TENANT) == tenant)
    df = df.where(time_filter(window, df))
    if STREAM_ID not in df.columns:
        df = df.withColumn(STREAM_ID, stream_id_of(labels_key_of(df)))
    if len(found) <= LISTED and len({r[STREAM_ID] for r in found}) == len(found):
        df = df.where(F.col(STREAM_ID).isin([r[STREAM_ID] for r in found]) if found else F.lit(False))
    else:
        df = df.join(chosen, [STREAM_ID, LABELS_KEY], "left_semi")
    if filters is not None:
        df = df.where(filters)
    return _finish(df, names, keep, limit, direction, window)


def _entries(spark: SparkSession, path: str, files: list[str] | None) -> DataFrame:
    """The table, or some of its files."""
    if files is None:
        return read_logs(spark, path)
    schema = stored_schema(spark, path)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*files).drop(BATCH)
