"""Overlapping pages of one selection, merged back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logframe import merge_pages, merge_pages_limited
from logframe.functions.timebounds import NANOS_PER_HOUR, NANOS_PER_SECOND, floor_div
from workload.registry import query
from workload.relations import CONV_LOGS, EPOCH_NS, conv_logs, ev_logs, with_relations
from workload.scans import ev_sql


def _paged(logs: DataFrame, origin_ns: int, width_ns: int, overlap_ns: int) -> DataFrame:
    """Serve ``logs`` in pages of ``width_ns`` that each repeat the start of the next one."""
    since = F.col("ts_ns") - F.lit(origin_ns)
    page = floor_div(since, width_ns)
    in_overlap = F.pmod(since, F.lit(width_ns)) < F.lit(overlap_ns)
    pages = F.when(in_overlap, F.array(page, page - 1)).otherwise(F.array(page))
    return logs.select("*", F.explode(pages).alias("page_id"))


def _ev_pages(spark, sf_dir) -> DataFrame:
    origin_ns = 1_704_067_200_000_000_000  # 2024-01-01
    return _paged(ev_logs(spark, sf_dir), origin_ns, 6 * NANOS_PER_HOUR, NANOS_PER_HOUR)


@query("merge_pages", ev_sql("SELECT event_id, ts_ns, line, labels_key FROM ev_logs"))
def merged(spark, sf_dir):
    return merge_pages(_ev_pages(spark, sf_dir)).select("event_id", "ts_ns", "line", "labels_key")


@query(
    "merge_then_limit",
    ev_sql("SELECT event_id, ts_ns, line FROM ev_logs ORDER BY ts_ns DESC, labels_key DESC, line DESC LIMIT 1500"),
)
def merged_limited(spark, sf_dir):
    top = merge_pages_limited(_ev_pages(spark, sf_dir), 1500, tie_breakers=["event_id"])
    return top.select("event_id", "ts_ns", "line")


@query("merge_same_ns", with_relations(CONV_LOGS, select="SELECT ts_ns, role, line, conv_id FROM conv_logs"))
def merged_same_ns(spark, sf_dir):
    """All turns with one number share an instant; pages hold two turns and repeat a third."""
    pages = _paged(conv_logs(spark, sf_dir), EPOCH_NS, 2 * NANOS_PER_SECOND, NANOS_PER_SECOND)
    return merge_pages(pages).select(
        "ts_ns", "role", "line", F.col("structured_metadata")["conv_id"].cast("bigint").alias("conv_id")
    )
