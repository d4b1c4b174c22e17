"""Logs with the rest of Spark: joins, aggregates, set operations.

Counts are taken per join key before a join, so a user with a large share of the
entries sends one row per task instead of all of them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from workload.registry import query
from workload.relations import read
from workload.scans import IN_WINDOW, ev_refine, ev_scan, ev_sql

ERRORS = [("level", "=", "error")]
SIGNUPS = [("level", "=", "warn")]
API = [("job", "=", "api")]


def _error_users(spark, sf_dir):
    errors = ev_scan(spark, sf_dir, ERRORS, keep=["user_id"])
    return errors.groupBy("user_id").agg(F.count("*").alias("entries"))


@query(
    "join_dimension",
    ev_sql(f"""
    SELECT c.c_mktsegment, count(*) AS entries FROM ev_logs e JOIN customer c ON e.user_id = c.c_custkey
    WHERE e.level = 'error' AND {IN_WINDOW} GROUP BY c.c_mktsegment
    """),
)
def join_dimension(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = _error_users(spark, sf_dir).join(customers, F.col("user_id") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.sum("entries").alias("entries"))


@query(
    "join_left",
    ev_sql(f"""
    SELECT e.event_id, e.line, c.c_name FROM ev_logs e
    LEFT JOIN customer c ON e.user_id = c.c_custkey AND c.c_acctbal > 5000
    WHERE e.level = 'error' AND {IN_WINDOW}
    """),
)
def join_left(spark, sf_dir):
    rich = read(spark, sf_dir, "customer").where(F.col("c_acctbal") > 5000).select("c_custkey", "c_name")
    errors = ev_scan(spark, sf_dir, ERRORS, keep=["event_id", "user_id"])
    return errors.join(rich, F.col("user_id") == F.col("c_custkey"), "left").select("event_id", "line", "c_name")


@query(
    "join_semi",
    ev_sql(f"""
    SELECT c_custkey, c_name FROM customer
    WHERE EXISTS (SELECT 1 FROM ev_logs WHERE user_id = c_custkey AND level = 'error' AND {IN_WINDOW})
    """),
)
def join_semi(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return customers.join(_error_users(spark, sf_dir), F.col("c_custkey") == F.col("user_id"), "left_semi")


@query(
    "join_anti",
    ev_sql(f"""
    SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM ev_logs WHERE user_id = c_custkey AND level = 'error' AND {IN_WINDOW})
    """),
)
def join_anti(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return customers.join(_error_users(spark, sf_dir), F.col("c_custkey") == F.col("user_id"), "left_anti")


@query(
    "join_two_scans",
    ev_sql(f"""
    SELECT e.job, count(*) AS pairs FROM ev_logs e JOIN ev_logs s ON e.user_id = s.user_id
    WHERE e.level = 'error' AND s.level = 'warn'
      AND e.{IN_WINDOW.replace("AND ts", "AND e.ts")} AND s.{IN_WINDOW.replace("AND ts", "AND s.ts")}
    GROUP BY e.job
    """),
)
def join_two_scans(spark, sf_dir):
    """Pairs of error and sign-up entries of one user, counted without building them."""
    errors = ev_scan(spark, sf_dir, ERRORS, labels=["job"], keep=["user_id"])
    signups = ev_scan(spark, sf_dir, SIGNUPS, keep=["user_id"])
    errors = errors.groupBy("user_id", "job").agg(F.count("*").alias("errors"))
    signups = signups.groupBy("user_id").agg(F.count("*").alias("signups"))
    pairs = errors.join(signups, "user_id")
    return pairs.groupBy("job").agg(F.sum(F.col("errors") * F.col("signups")).alias("pairs"))


@query("count_selected", ev_sql(f"SELECT count(*) AS entries FROM ev_logs WHERE job = 'api' AND level = 'error' AND {IN_WINDOW}"))
def count_selected(spark, sf_dir):
    return ev_scan(spark, sf_dir, API + ERRORS).agg(F.count("*").alias("entries"))


@query("count_empty", ev_sql("SELECT event_id, line FROM ev_logs WHERE job = 'nothing'"))
def count_empty(spark, sf_dir):
    return ev_scan(spark, sf_dir, [("job", "=", "nothing")]).select("event_id", "line")


@query(
    "count_by_label",
    ev_sql(f"SELECT job, level, pod, count(*) AS entries FROM ev_logs WHERE job <> '' AND {IN_WINDOW} GROUP BY ALL"),
)
def count_by_label(spark, sf_dir):
    labels = ["job", "level", "pod"]
    scan = ev_scan(spark, sf_dir, [("job", "=~", ".+")], labels=labels)
    return scan.groupBy(*labels).agg(F.count("*").alias("entries"))


@query(
    "scan_except",
    ev_sql(f"""
    SELECT ts_ns, line FROM ev_logs WHERE job = 'api' AND {IN_WINDOW}
    EXCEPT SELECT ts_ns, line FROM ev_logs WHERE level = 'error' AND {IN_WINDOW}
    """),
)
def scan_except(spark, sf_dir):
    api = ev_scan(spark, sf_dir, API).select("ts_ns", "line")
    return api.subtract(ev_scan(spark, sf_dir, ERRORS).select("ts_ns", "line"))


@query(
    "scan_agreement",
    ev_sql(f"""
    , a AS (
      SELECT ts_ns, line FROM ev_logs WHERE job = 'api' AND level = 'error' AND line LIKE '%user=3%' AND {IN_WINDOW}
    ), b AS (
      SELECT ts_ns, line FROM ev_logs WHERE level = 'error' AND contains(line, 'user=3') AND job = 'api' AND {IN_WINDOW}
    )
    SELECT CAST((SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b))
      + (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a))
      + CASE WHEN (SELECT count(*) FROM a) = 0 THEN 1 ELSE 0 END AS BIGINT) AS disagreement
    """),
)
def scan_agreement(spark, sf_dir):
    """A refined scan and a plain scan of the same selection differ nowhere, and are not empty."""
    contains = [("contains", "user=3")]
    refined = ev_refine(spark, sf_dir, API, labels=["level"], label_where=[("level", "=", "error")], line=contains)
    plain = ev_scan(spark, sf_dir, API + ERRORS, line=contains)
    refined, plain = refined.select("ts_ns", "line"), plain.select("ts_ns", "line")
    differing = refined.subtract(plain).unionByName(plain.subtract(refined)).agg(F.count("*").alias("n"))
    empty = F.when(refined.agg(F.count("*")).scalar() == 0, 1).otherwise(0)
    return differing.select((F.col("n") + empty).cast("bigint").alias("disagreement"))
