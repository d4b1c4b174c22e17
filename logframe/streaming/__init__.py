"""Structured Streaming: landing captured payloads, following a log table, merging pages as they arrive."""

from logframe.streaming.ingest import ingest_payloads, log_stream, payload_stream, tail_logs
from logframe.streaming.pages import merge_pages_stream

__all__ = ["ingest_payloads", "log_stream", "merge_pages_stream", "payload_stream", "tail_logs"]
