"""Detected patterns and fields of lines."""

from __future__ import annotations

from logframe import detected_fields, detected_patterns
from workload.registry import query
from workload.relations import ev_logs
from workload.scans import END, IN_WINDOW, START, ev_sql

MASKED = "regexp_replace(line, '[A-Za-z_]*[0-9][A-Za-z0-9_]*', '<_>', 'g')"


@query(
    "detected_patterns",
    ev_sql(f"""
    SELECT job, {MASKED} AS pattern, count(*) AS entries, min(ts_ns) AS first_ns, max(ts_ns) AS last_ns
    FROM ev_logs WHERE {IN_WINDOW} GROUP BY ALL
    """),
)
def patterns(spark, sf_dir):
    return detected_patterns(ev_logs(spark, sf_dir), [("job", "=~", ".+")], by=["job"], start=START, end=END)


@query(
    "patterns_merged",
    ev_sql(f"""
    , masked AS (SELECT string_split({MASKED}, ' ') AS ts FROM ev_logs WHERE {IN_WINDOW}),
    crowded AS (SELECT len(ts) AS size, count(DISTINCT ts[1]) > 3 AS many FROM masked GROUP BY len(ts))
    SELECT array_to_string(list_concat([CASE WHEN many THEN '<_>' ELSE ts[1] END], ts[2:]), ' ') AS pattern, count(*) AS entries
    FROM masked JOIN crowded ON size = len(ts) GROUP BY ALL
    """),
)
def merged_patterns(spark, sf_dir):
    """The first word of a line becomes variable where it has more than three forms."""
    found = detected_patterns(ev_logs(spark, sf_dir), [("job", "=~", ".+")], depth=1, most=3, start=START, end=END)
    return found.select("pattern", "entries")


@query(
    "detected_fields",
    ev_sql(f"""
    , pairs AS (SELECT unnest(regexp_extract_all(line, '(?:^|[\\s,({{\\[])([A-Za-z_][A-Za-z0-9_.-]*)=("[^"]*"|[^\\s,)}}\\]]*)', 1)) AS field,
      unnest(regexp_extract_all(line, '(?:^|[\\s,({{\\[])([A-Za-z_][A-Za-z0-9_.-]*)=("[^"]*"|[^\\s,)}}\\]]*)', 2)) AS v FROM ev_logs WHERE {IN_WINDOW}),
    vals AS (SELECT field, regexp_replace(v, '^"(.*)"$', '\\1') AS value FROM pairs)
    SELECT field, CASE WHEN bool_and(regexp_full_match(value, '[+-]?[0-9]+')) THEN 'int' WHEN bool_and(regexp_full_match(value, '[+-]?[0-9]+(\\.[0-9]+)?([eE][+-]?[0-9]+)?')) THEN 'float'
      WHEN bool_and(value IN ('true', 'false')) THEN 'boolean' ELSE 'string' END AS kind, count(*) AS entries, count(DISTINCT value) AS distinct_values
    FROM vals GROUP BY field
    """),
)
def fields(spark, sf_dir):
    return detected_fields(ev_logs(spark, sf_dir), [("job", "=~", ".+")], start=START, end=END)
