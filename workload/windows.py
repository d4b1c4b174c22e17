"""Time windows, limits and order."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from logframe import Window, newest, refine_logs, scan_logs
from workload.lines import ANY_LANG
from workload.registry import query
from workload.relations import CONV_LOGS, DOC_LOGS, conv_logs, doc_logs, ev_logs, with_relations
from workload.scans import END, IN_WINDOW, START, ev_scan, ev_sql

API = [("job", "=", "api")]
ERRORS = [("level", "=", "error")]
LABELLED = "event_id, ts_ns, line"


def _timed(name, condition, **arguments):
    @query(name, ev_sql(f"SELECT {LABELLED} FROM ev_logs WHERE job = 'api' AND {condition}"))
    def run(spark, sf_dir):
        scan = refine_logs(ev_logs(spark, sf_dir), API, keep=["event_id"], limit=None, **arguments)
        return scan.select("event_id", "ts_ns", "line")


_timed(
    "time_lower",
    "ts >= TIMESTAMP '2024-01-12' AND ts > TIMESTAMP '2024-01-12 06:00:00' AND ts < TIMESTAMP '2024-01-20'",
    time_where=[(">=", "2024-01-12"), (">", "2024-01-12 06:00:00")],
    end=END,
)
_timed(
    "time_upper",
    "ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-09' AND ts <= TIMESTAMP '2024-01-08 12:00:00'",
    time_where=[("<", "2024-01-09"), ("<=", "2024-01-08 12:00:00")],
    start=START,
)
_timed(
    "time_between",
    "ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-11'",
    time_where=[(">=", "2024-01-10"), ("<=", "2024-01-11")],
)
_timed(
    "time_intersect",
    "ts >= TIMESTAMP '2024-01-07' AND ts < TIMESTAMP '2024-01-15'",
    time_where=[(">=", "2024-01-03"), (">=", "2024-01-07"), ("<", "2024-01-18"), ("<", "2024-01-15")],
)
_timed(
    "time_param_and_where",
    "ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-12'",
    time_where=[(">=", "2024-01-08"), ("<", "2024-01-16")],
    start=START,
    end=datetime(2024, 1, 12),
)
_timed(
    "time_default_window",
    "ts >= TIMESTAMP '2024-01-15 11:00:00' AND ts < TIMESTAMP '2024-01-15 12:00:00'",
    now="2024-01-15 12:00:00",
)
_timed(
    "time_interval_offset",
    "ts >= TIMESTAMP '2024-01-13' AND ts < TIMESTAMP '2024-01-15'",
    start=timedelta(days=-2),
    now="2024-01-15",
)


@query(
    "time_eq",
    with_relations(
        DOC_LOGS,
        select="SELECT doc_id, line_no, line FROM doc_logs WHERE lang <> '' AND ts_ns = 1700000100000000000",
    ),
)
def time_eq(spark, sf_dir):
    instant = [("=", 1_700_000_100_000_000_000)]
    scan = refine_logs(doc_logs(spark, sf_dir), ANY_LANG, keep=["doc_id", "line_no"], limit=None, time_where=instant)
    return scan.select("doc_id", "line_no", "line")


@query(
    "time_ns_exact",
    with_relations(
        DOC_LOGS,
        select="""
        SELECT doc_id, line_no, ts_ns FROM doc_logs
        WHERE lang <> '' AND ts_ns >= 1700000100000000001 AND ts_ns < 1700000200000000000
        """,
    ),
)
def time_ns_exact(spark, sf_dir):
    bounds = {"start": 1_700_000_100_000_000_001, "end": 1_700_000_200_000_000_000}
    scan = scan_logs(doc_logs(spark, sf_dir), ANY_LANG, keep=["doc_id", "line_no"], limit=None, **bounds)
    return scan.select("doc_id", "line_no", "ts_ns")


def _top(name, direction, order):
    @query(
        name,
        ev_sql(f"""
        SELECT {LABELLED} FROM ev_logs WHERE level = 'error' AND {IN_WINDOW}
        ORDER BY ts_ns {order}, labels_key {order}, line {order}, event_id {order} LIMIT 100
        """),
    )
    def run(spark, sf_dir):
        return ev_scan(spark, sf_dir, ERRORS, limit=100, direction=direction).select("event_id", "ts_ns", "line")


_top("newest_n", "backward", "DESC")
_top("oldest_n", "Forward", "ASC")


@query(
    "limit_then_residual",
    ev_sql(f"""
    SELECT {LABELLED} FROM (
      SELECT * FROM ev_logs WHERE job = 'api' AND {IN_WINDOW} ORDER BY ts_ns DESC LIMIT 500
    ) WHERE level = 'warn'
    """),
)
def limit_then_residual(spark, sf_dir):
    scan = ev_scan(spark, sf_dir, API, labels=["level"], limit=500)
    return scan.where(F.col("level") == "warn").select("event_id", "ts_ns", "line")


@query(
    "newest_narrowed",
    with_relations(
        CONV_LOGS,
        select="""
        SELECT ts_ns, role, line, conv_id FROM conv_logs
        ORDER BY ts_ns, labels_key, line, conv_id LIMIT 300
        """,
    ),
)
def newest_narrowed(spark, sf_dir):
    """A limit inside one instant that very many entries share: all first turns."""
    logs = conv_logs(spark, sf_dir).withColumn("conv_id", F.col("structured_metadata")["conv_id"].cast("bigint"))
    first = newest(logs.drop("structured_metadata"), 300, "forward", Window(), ["conv_id"])
    return first.select("ts_ns", F.col("labels")["role"].alias("role"), "line", "conv_id")


@query("order_by_time", ev_sql(f"SELECT {LABELLED} FROM ev_logs WHERE job = 'api' AND level = 'error' AND {IN_WINDOW} ORDER BY ts_ns"))
def order_by_time(spark, sf_dir):
    return ev_scan(spark, sf_dir, API + ERRORS).orderBy("ts_ns", "event_id").select("event_id", "ts_ns", "line")
