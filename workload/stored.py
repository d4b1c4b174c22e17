"""Tables at rest with side tables: discovery, scans by label set, limits by day, pages as a stream."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from logframe import attach, indexed_series, label_names, labels_key_of, land_batch, read_logs, refresh_index, refresh_text_index, scan_logs, scan_table, series
from logframe.functions.timebounds import NANOS_PER_SECOND
from logframe.streaming import merge_pages_stream
from workload.paging import _paged
from workload.registry import ORACLES, query
from workload.relations import EPOCH_NS, conv_logs, ev_logs
from workload.scans import END, IN_WINDOW, START, ev_sql

_folders: dict[str, str] = {}
_tables: dict[tuple[str, str], str] = {}


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared folder that the session names, or in a temporary one of a local session."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if "local" not in _folders:
            _folders["local"] = tempfile.mkdtemp(prefix="workload-")
            atexit.register(shutil.rmtree, _folders["local"], ignore_errors=True)
        shared = "file://" + _folders["local"]
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored_events(spark: SparkSession, sf_dir: str) -> str:
    """``ev_logs`` at rest in two batches, one of them landed twice, with side tables; written once in a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _tables:
        path, logs = scratch_folder(spark, "events"), ev_logs(spark, sf_dir)
        first = F.col("event_id") % 2 == 0
        land_batch(logs.where(first), path, "even")
        refresh_index(spark, path)
        land_batch(logs.where(~first), path, "odd")
        land_batch(logs.where(~first), path, "odd")
        refresh_index(spark, path)
        refresh_text_index(spark, path)
        _tables[key] = path
    return _tables[key]


@query("indexed_label_names", ORACLES["label_names"])
def indexed_names(spark, sf_dir):
    return label_names(indexed_series(spark, stored_events(spark, sf_dir), start=START, end=END))


@query("indexed_series", ORACLES["series"])
def indexed_sets(spark, sf_dir):
    found = series(indexed_series(spark, stored_events(spark, sf_dir), start=START, end=END), [("job", "=~", ".+")])
    return found.select(labels_key_of(found).alias("labels_key"))


@query(
    "attach_indexed",
    ev_sql("SELECT DISTINCT tenant, job, level, pod FROM ev_logs"),
)
def attached(spark, sf_dir):
    """The series of both tenants, with the labels found, from the side table alone."""
    db = attach(spark, stored_events(spark, sf_dir), "kept", tenants=["1", "2"])
    parts = [db.table(spark, "series", tenant).select(F.lit(tenant).alias("tenant"), *db.labels[tenant]) for tenant in db.tenants]
    return parts[0].union(parts[1])


@query(
    "table_scan",
    ev_sql(f"SELECT event_id, ts_ns, line, pod FROM ev_logs WHERE regexp_full_match(job, 'a.i|work.*') AND (pod IS NULL OR NOT regexp_full_match(pod, 'api-[01]')) AND level <> 'info' AND {IN_WINDOW}"),
)
def scanned(spark, sf_dir):
    """Patterns on labels, evaluated on label sets alone."""
    selector = '{job=~"a.i|work.*", pod!~"api-[01]", level!="info"}'
    return scan_table(spark, stored_events(spark, sf_dir), selector, labels=["pod"], keep=["event_id"], start=START, end=END, limit=None).select("event_id", "ts_ns", "line", "pod")


@query("table_scan_text", ev_sql(f"SELECT event_id, ts_ns, line FROM ev_logs WHERE job = 'api' AND contains(line, 'user=33 ') AND {IN_WINDOW}"))
def scanned_text(spark, sf_dir):
    """A literal looked up in the text index."""
    scan = scan_table(spark, stored_events(spark, sf_dir), '{job="api"} |= "user=33 "', keep=["event_id"], start=START, end=END, limit=None)
    return scan.select("event_id", "ts_ns", "line")


@query("table_all_labels", ev_sql(f"SELECT event_id, job, level, pod FROM ev_logs WHERE job = 'api' AND level = 'error' AND {IN_WINDOW}"))
def scanned_with_all_labels(spark, sf_dir):
    """Every label found becomes a column."""
    scan = scan_table(spark, stored_events(spark, sf_dir), '{job="api", level="error"}', labels="*", keep=["event_id"], start=START, end=END, limit=None)
    return scan.drop("timestamp", "ts_ns", "line", "labels", "structured_metadata")


@query("table_newest", ev_sql(f"SELECT event_id, ts_ns, line FROM ev_logs WHERE level = 'error' AND {IN_WINDOW} ORDER BY ts_ns DESC, labels_key DESC, line DESC, event_id DESC LIMIT 100"))
def newest_of_table(spark, sf_dir):
    """The newest entries, from the newest days only."""
    logs = read_logs(spark, stored_events(spark, sf_dir))
    return scan_logs(logs, [("level", "=", "error")], start=START, end=END, limit=100, keep=["event_id"]).select("event_id", "ts_ns", "line")


@query("merge_pages_stream", ORACLES["merge_same_ns"])
def merged_stream(spark, sf_dir) -> DataFrame:
    """Overlapping pages that arrive as files, merged with what is kept of each entry."""
    pages, inbox, out = _paged(conv_logs(spark, sf_dir), EPOCH_NS, 2 * NANOS_PER_SECOND, NANOS_PER_SECOND), scratch_folder(spark, "inbox"), scratch_folder(spark, "merged")
    pages.select("ts_ns", "timestamp", "line", "role", "labels", "labels_key", "structured_metadata", "page_id").write.parquet(inbox)
    arriving = spark.readStream.schema(spark.read.parquet(inbox).schema).option("maxFilesPerTrigger", 4).parquet(inbox)
    stream = merge_pages_stream(arriving, delay="1 day").writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_folder(spark, "progress"))
    stream.trigger(availableNow=True).start().awaitTermination()
    found = spark.read.parquet(out)
    return found.select("ts_ns", F.col("labels")["role"].alias("role"), "line", F.col("structured_metadata")["conv_id"].cast("bigint").alias("conv_id"))
