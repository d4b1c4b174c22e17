"""Stream selectors (a missing label is the empty string) and label predicates (it is NULL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from workload.registry import query
from workload.scans import IN_WINDOW, ev_refine, ev_scan, ev_sql


def _selected(name, condition, selector):
    @query(name, ev_sql(f"SELECT event_id, job, level, pod FROM ev_logs WHERE {condition} AND {IN_WINDOW}"))
    def run(spark, sf_dir):
        scan = ev_scan(spark, sf_dir, selector, labels=["job", "level", "pod"])
        return scan.select("event_id", "job", "level", "pod")


_selected("sel_eq", "job = 'web'", [("job", "=", "web")])
_selected("sel_neq", "level = 'error' AND (pod IS NULL OR pod <> 'api-0')", [("level", "=", "error"), ("pod", "!=", "api-0")])
_selected("sel_re", "regexp_full_match(coalesce(job, ''), 'w.*')", [("job", "=~", "w.*")])
_selected(
    "sel_nre",
    "level = 'warn' AND NOT regexp_full_match(coalesce(pod, ''), 'api-[01]')",
    [("level", "=", "warn"), ("pod", "!~", "api-[01]")],
)
_selected("sel_re_nocase", "regexp_full_match(coalesce(job, ''), '(?i)W[A-F]B')", [("job", "=~", "(?i)W[A-F]B")])
_selected("sel_empty", "level = 'warn' AND coalesce(pod, '') = ''", [("level", "=", "warn"), ("pod", "=", "")])


@query(
    "line_regex_json",
    ev_sql(f"""
    SELECT event_id, line FROM ev_logs WHERE job = 'api' AND regexp_matches(line, '{{"k": [0-9]+}}$') AND {IN_WINDOW}
    """),
)
def line_regex_json(spark, sf_dir):
    scan = ev_scan(spark, sf_dir, [("job", "=", "api")], line=[("regex", '{"k": [0-9]+}$')])
    return scan.select("event_id", "line")


@query(
    "scan_text",
    ev_sql(f"""
    SELECT event_id, line FROM ev_logs
    WHERE job <> 'web' AND regexp_full_match(level, 'err.*|warn') AND contains(line, 'user=1')
      AND NOT regexp_matches(line, 'user=1[0-4] ') AND {IN_WINDOW}
    """),
)
def scan_text(spark, sf_dir):
    text = '{level=~"err.*|warn", job!="web"} |= "user=1" !~ `user=1[0-4] `'
    return ev_scan(spark, sf_dir, text).select("event_id", "line")


@query(
    "sel_refine",
    ev_sql(f"""
    SELECT event_id, job, level, pod FROM ev_logs
    WHERE regexp_full_match(job, 'api|web') AND level <> 'info' AND (pod IS NULL OR pod <> 'api-1') AND {IN_WINDOW}
    """),
)
def sel_refine(spark, sf_dir):
    base = [("job", "=~", "api|web")]
    extra = [("level", "!=", "info"), ("pod", "!=", "api-1")]
    return ev_scan(spark, sf_dir, base + extra, labels=["job", "level", "pod"]).select("event_id", "job", "level", "pod")


def _refined(name, condition, selector, label_where):
    @query(name, ev_sql(f"SELECT event_id, job, level, pod FROM ev_logs WHERE {condition} AND {IN_WINDOW}"))
    def run(spark, sf_dir):
        scan = ev_refine(spark, sf_dir, selector, labels=["job", "level", "pod"], label_where=label_where)
        return scan.select("event_id", "job", "level", "pod")


_refined("where_label_eq", "job = 'api' AND level = 'error'", [("job", "=", "api")], [("level", "=", "error")])
_refined("where_label_neq", "level = 'error' AND pod <> 'api-0'", [("level", "=", "error")], [("pod", "!=", "api-0")])
_refined("where_label_in", "level IN ('error', 'warn')", [], [("level", "in", ["error", "warn"])])


@query(
    "where_label_like",
    ev_sql(f"""
    SELECT event_id, job, level, pod FROM ev_logs
    WHERE job = 'api' AND pod LIKE 'api-%' AND pod > 'api-1' AND regexp_matches(level, 'rr|ar') AND {IN_WINDOW}
    """),
)
def where_label_like(spark, sf_dir):
    scan = ev_scan(spark, sf_dir, [("job", "=", "api")], labels=["job", "level", "pod"])
    pod, level = F.col("pod"), F.col("level")
    return scan.where(pod.like("api-%") & (pod > "api-1") & level.rlike("rr|ar")).select("event_id", "job", "level", "pod")


@query(
    "where_map_label",
    ev_sql(f"SELECT event_id, line FROM ev_logs WHERE job = 'api' AND pod = 'api-2' AND {IN_WINDOW}"),
)
def where_map_label(spark, sf_dir):
    scan = ev_scan(spark, sf_dir, [("job", "=", "api")])
    return scan.where(F.col("labels")["pod"] == "api-2").select("event_id", "line")
