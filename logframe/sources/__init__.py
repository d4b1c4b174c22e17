"""Where logs come from: tables at rest, captured payloads, attached views."""

from logframe.sources.catalog import Attached, attach, string_list
from logframe.sources.payload import (
    parse_series,
    parse_streams,
    parse_string_array,
    payload_rejects,
    read_payloads,
)
from logframe.sources.series_index import indexed_series, refresh_index
from logframe.sources.tables import compact_logs, land_batch, read_logs, write_logs
from logframe.sources.text_index import refresh_text_index

__all__ = [
    "Attached",
    "attach",
    "compact_logs",
    "indexed_series",
    "land_batch",
    "parse_series",
    "parse_streams",
    "parse_string_array",
    "payload_rejects",
    "read_logs",
    "read_payloads",
    "refresh_index",
    "refresh_text_index",
    "string_list",
    "write_logs",
]
