"""Scans, views, promotion, map access."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logframe import attach, label_values, refine_logs, scan_logs
from workload.registry import query
from workload.relations import CONV_LOGS, EV_LOGS, conv_logs, ev_logs, with_relations

START, END = "2024-01-05", "2024-01-20"
IN_WINDOW = "ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'"


def ev_sql(select: str) -> str:
    return with_relations(EV_LOGS, select=select)


def ev_scan(spark, sf_dir, selector, labels=(), keep=("event_id",), limit=None, **arguments) -> DataFrame:
    """A scan of ``ev_logs`` in the common window."""
    bounds = {"start": START, "end": END, **arguments}
    return scan_logs(ev_logs(spark, sf_dir), selector, labels=labels, keep=keep, limit=limit, **bounds)


def ev_refine(spark, sf_dir, selector=(), labels=(), keep=("event_id",), limit=None, **arguments) -> DataFrame:
    bounds = {"start": START, "end": END, **arguments}
    return refine_logs(ev_logs(spark, sf_dir), selector, labels=labels, keep=keep, limit=limit, **bounds)


@query("scan_raw", ev_sql(f"SELECT event_id, ts_ns, line FROM ev_logs WHERE job = 'api' AND {IN_WINDOW}"))
def scan_raw(spark, sf_dir):
    return ev_scan(spark, sf_dir, [("job", "=", "api")]).select("event_id", "ts_ns", "line")


@query(
    "scan_refined",
    ev_sql(f"""
    SELECT event_id, ts_ns, level, line FROM ev_logs
    WHERE job = 'api' AND level = 'error' AND line LIKE '%user=3%' AND {IN_WINDOW}
    """),
)
def scan_refined(spark, sf_dir):
    refined = ev_refine(
        spark,
        sf_dir,
        [("job", "=", "api")],
        labels=["level"],
        label_where=[("level", "=", "error")],
        line=[("contains", "user=3")],
    )
    return refined.select("event_id", "ts_ns", "level", "line")


@query("view_logs", ev_sql("SELECT ts_ns, level, line FROM ev_logs WHERE tenant = '1' AND job = 'web'"))
def view_logs(spark, sf_dir):
    db = attach(spark, ev_logs(spark, sf_dir), "viewed", tenants="1,2", labels=["job", "level"])
    return spark.sql(f"SELECT ts_ns, level, line FROM {db.view_name('logs', '1')} WHERE job = 'web'")


@query(
    "view_pushdown",
    ev_sql(f"""
    SELECT ts_ns, line FROM ev_logs
    WHERE job = 'api' AND level = 'error' AND ts >= TIMESTAMP '2024-01-10' AND {IN_WINDOW}
    """),
)
def view_pushdown(spark, sf_dir):
    wide = ev_scan(spark, sf_dir, [("job", "=~", ".+")], labels=["job", "level"])
    wide.createOrReplaceTempView("pushed_logs")
    return spark.sql("""
        SELECT ts_ns, line FROM pushed_logs
        WHERE job = 'api' AND level = 'error' AND timestamp >= TIMESTAMP_NTZ '2024-01-10'
    """)


@query(
    "tenant_logs",
    ev_sql("SELECT level, count(*) AS entries FROM ev_logs WHERE tenant = '2' GROUP BY level"),
)
def tenant_logs(spark, sf_dir):
    db = attach(spark, ev_logs(spark, sf_dir), "tenanted", tenants=["1", "2"], labels=["level"])
    return db.table(spark, "logs", "2").groupBy("level").agg(F.count("*").alias("entries"))


@query(
    "attach_autolabels",
    ev_sql("""
    SELECT job, level, pod, count(*) AS entries FROM ev_logs WHERE tenant = '1' GROUP BY job, level, pod
    """),
)
def attach_autolabels(spark, sf_dir):
    db = attach(spark, ev_logs(spark, sf_dir), "discovered", tenants="1")
    return db.table(spark).groupBy(*db.labels["1"]).agg(F.count("*").alias("entries"))


@query(
    "promote_labels",
    ev_sql(f"SELECT event_id, pod, level, job FROM ev_logs WHERE level <> 'info' AND {IN_WINDOW}"),
)
def promote_labels(spark, sf_dir):
    scan = ev_scan(spark, sf_dir, [("level", "=~", "error|warn")], labels=["pod", "level", "job"])
    return scan.select("event_id", "pod", "level", "job")


@query(
    "map_lookup",
    ev_sql(f"""
    SELECT event_id, job, pod, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS absent
    FROM ev_logs WHERE job IN ('api', 'web') AND {IN_WINDOW}
    """),
)
def map_lookup(spark, sf_dir):
    labels, metadata = F.col("labels"), F.col("structured_metadata")
    return ev_scan(spark, sf_dir, [("job", "!=", "worker"), ("level", "=~", ".+")]).select(
        "event_id",
        labels["job"].alias("job"),
        labels["pod"].alias("pod"),
        metadata["k"].alias("k"),
        labels["nothing"].alias("absent"),
    )


@query(
    "metadata_size",
    ev_sql(f"""
    SELECT event_id, CAST(1 + CASE WHEN json_extract_string(props, '$.k') IS NULL THEN 0 ELSE 1 END AS INTEGER)
      AS entries
    FROM ev_logs WHERE job = 'api' AND {IN_WINDOW}
    """),
)
def metadata_size(spark, sf_dir):
    scan = ev_scan(spark, sf_dir, [("job", "=", "api")])
    return scan.select("event_id", F.size("structured_metadata").alias("entries"))


@query("epoch_ns_roundtrip", with_relations(CONV_LOGS, select="SELECT conv_id, turn, ts_ns, ts_ns // 1000 AS ts_us FROM conv_logs"))
def epoch_ns_roundtrip(spark, sf_dir):
    logs = conv_logs(spark, sf_dir)
    since = (F.col("timestamp") - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")).cast("interval second")
    return logs.select(
        F.col("structured_metadata")["conv_id"].cast("bigint").alias("conv_id"),
        F.col("structured_metadata")["turn"].cast("bigint").alias("turn"),
        "ts_ns",
        (since.cast("decimal(18,6)") * 1_000_000).cast("bigint").alias("ts_us"),
    )


@query("distinct_label", ev_sql(f"SELECT DISTINCT pod AS pod FROM ev_logs WHERE level = 'error' AND {IN_WINDOW}"))
def distinct_label(spark, sf_dir):
    return ev_scan(spark, sf_dir, [("level", "=", "error")]).select(F.col("labels")["pod"].alias("pod")).distinct()


@query(
    "label_values",
    ev_sql("SELECT DISTINCT pod AS value FROM ev_logs WHERE pod IS NOT NULL"),
)
def values_of_label(spark, sf_dir):
    return label_values(ev_logs(spark, sf_dir), "pod")
