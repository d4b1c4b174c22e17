"""Operators over log tables: scans, top-k, discovery, page merging, volume over time."""

from logframe.operators.discover import label_names, label_values, series, series_of
from logframe.operators.topk import newest
from logframe.operators.pages import merge_pages, merge_pages_limited
from logframe.operators.patterns import detected_fields, detected_patterns
from logframe.operators.scan import DEFAULT_LIMIT, refine_logs, scan_logs
from logframe.operators.table_scan import scan_table
from logframe.operators.volume import bytes_over_time, bytes_rate, count_over_time, rate

__all__ = [
    "DEFAULT_LIMIT",
    "bytes_over_time",
    "bytes_rate",
    "count_over_time",
    "detected_fields",
    "detected_patterns",
    "label_names",
    "label_values",
    "merge_pages",
    "merge_pages_limited",
    "newest",
    "rate",
    "refine_logs",
    "scan_logs",
    "scan_table",
    "series",
    "series_of",
]
