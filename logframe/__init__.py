"""Logs as tables: selectors, line filters, time windows and discovery on Spark DataFrames."""

from logframe.functions.timebounds import Window, explicit_window, time_filter
from logframe.model import label_column, labels_key_of, log_table
from logframe.operators import (
    DEFAULT_LIMIT,
    bytes_over_time,
    bytes_rate,
    count_over_time,
    detected_fields,
    detected_patterns,
    label_names,
    label_values,
    merge_pages,
    merge_pages_limited,
    newest,
    rate,
    refine_logs,
    scan_logs,
    scan_table,
    series,
)
from logframe.sources import (
    Attached,
    attach,
    compact_logs,
    indexed_series,
    land_batch,
    parse_series,
    parse_streams,
    parse_string_array,
    payload_rejects,
    read_logs,
    read_payloads,
    refresh_index,
    refresh_text_index,
    write_logs,
)

__all__ = [
    "Attached",
    "DEFAULT_LIMIT",
    "Window",
    "attach",
    "bytes_over_time",
    "bytes_rate",
    "compact_logs",
    "count_over_time",
    "detected_fields",
    "detected_patterns",
    "explicit_window",
    "indexed_series",
    "label_column",
    "label_names",
    "label_values",
    "labels_key_of",
    "land_batch",
    "log_table",
    "merge_pages",
    "merge_pages_limited",
    "newest",
    "parse_series",
    "parse_streams",
    "parse_string_array",
    "payload_rejects",
    "rate",
    "read_logs",
    "read_payloads",
    "refine_logs",
    "refresh_index",
    "refresh_text_index",
    "scan_logs",
    "scan_table",
    "series",
    "time_filter",
    "write_logs",
]
