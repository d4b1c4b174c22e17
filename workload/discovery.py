"""Label names, values of a label under a selector, series."""

from __future__ import annotations

from pyspark.sql import functions as F

from logframe import attach, label_names, label_values, labels_key_of, scan_logs, series
from workload.registry import query
from workload.relations import ev_logs
from workload.scans import END, IN_WINDOW, START, ev_sql


@query(
    "label_names",
    ev_sql(f"""
    SELECT 'job' AS label WHERE EXISTS (SELECT 1 FROM ev_logs WHERE job IS NOT NULL AND {IN_WINDOW})
    UNION SELECT 'level' WHERE EXISTS (SELECT 1 FROM ev_logs WHERE level IS NOT NULL AND {IN_WINDOW})
    UNION SELECT 'pod' WHERE EXISTS (SELECT 1 FROM ev_logs WHERE pod IS NOT NULL AND {IN_WINDOW})
    """),
)
def names(spark, sf_dir):
    return label_names(ev_logs(spark, sf_dir), start=START, end=END)


@query(
    "label_values_selected",
    ev_sql(f"SELECT DISTINCT level AS value FROM ev_logs WHERE job = 'web' AND {IN_WINDOW}"),
)
def values_selected(spark, sf_dir):
    return label_values(ev_logs(spark, sf_dir), "level", selector=[("job", "=", "web")], start=START, end=END)


@query("series", ev_sql(f"SELECT DISTINCT labels_key FROM ev_logs WHERE job <> '' AND {IN_WINDOW}"))
def all_series(spark, sf_dir):
    found = series(ev_logs(spark, sf_dir), [("job", "=~", ".+")], start=START, end=END)
    return found.select(labels_key_of(found).alias("labels_key"))


@query(
    "series_promoted",
    ev_sql("SELECT DISTINCT job, level, pod, labels_key FROM ev_logs WHERE job = 'api' AND level IN ('error', 'warn')"),
)
def series_promoted(spark, sf_dir):
    db = attach(spark, ev_logs(spark, sf_dir), "explored", labels=["job", "level", "pod"])
    view = spark.sql(f"SELECT * FROM {db.view_name('series')} WHERE job = 'api' AND level IN ('error', 'warn')")
    return view.select("job", "level", "pod", labels_key_of(view).alias("labels_key"))


@query(
    "view_labels",
    ev_sql("""
    SELECT 'job' AS label FROM ev_logs WHERE job IS NOT NULL UNION SELECT 'level' FROM ev_logs WHERE level IS NOT NULL
    UNION SELECT 'pod' FROM ev_logs WHERE pod IS NOT NULL
    """),
)
def view_labels(spark, sf_dir):
    db = attach(spark, ev_logs(spark, sf_dir), "named", labels=[])
    return db.table(spark, "labels").select(F.col("label"))


@query(
    "label_shadowed",
    ev_sql(f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, job, level FROM ev_logs WHERE job = 'web' AND level <> 'info' AND {IN_WINDOW}
    """),
)
def label_shadowed(spark, sf_dir):
    """A kept text column that has the name of a label does not stand for the label."""
    logs = ev_logs(spark, sf_dir).drop("job", "level").withColumn("job", F.lit("none")).withColumn("level", F.col("event_id").cast("string"))
    scan = scan_logs(logs, [("job", "=", "web"), ("level", "!=", "info")], start=START, end=END, limit=None, keep=["level"])
    return scan.select(F.col("level").alias("event_id"), F.col("labels")["job"].alias("job"), F.col("labels")["level"].alias("level"))
