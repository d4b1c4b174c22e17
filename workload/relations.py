"""Log tables derived from the driver's tables, in Spark and as SQL for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logframe.functions.timebounds import NANOS_PER_SECOND, counted_time, ns_of_timestamp
from logframe.model import log_table

EPOCH_NS = 1_700_000_000_000_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ev_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as logs with labels job, level and (sparse) pod, for tenants 1 and 2."""
    return log_table(
        read(spark, sf_dir, "events"),
        tenant=F.expr("user_id % 2 + 1"),
        ts_ns=ns_of_timestamp(F.col("ts")),
        timestamp=F.col("ts"),
        line=F.expr("concat(event_type, ' user=', user_id, ' props=', props)"),
        labels={
            "job": F.expr("CASE user_id % 3 WHEN 0 THEN 'api' WHEN 1 THEN 'web' ELSE 'worker' END"),
            "level": F.expr("CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'warn' ELSE 'info' END"),
            "pod": F.expr("CASE WHEN user_id % 3 = 0 THEN concat('api-', user_id % 4) END"),
        },
        metadata={
            "event_id": F.col("event_id"),
            "k": F.get_json_object("props", "$.k"),
        },
        keep=["event_id", "user_id"],
    )


EV_LOGS = """
ev_logs AS (
  SELECT *, concat('{"job":"', job, '","level":"', level, '"',
                   CASE WHEN pod IS NULL THEN '' ELSE concat(',"pod":"', pod, '"') END, '}') AS labels_key
  FROM (
    SELECT event_id, user_id, ts, epoch_us(ts) * 1000 AS ts_ns, props,
      concat(event_type, ' user=', CAST(user_id AS VARCHAR), ' props=', props) AS line,
      CASE user_id % 3 WHEN 0 THEN 'api' WHEN 1 THEN 'web' ELSE 'worker' END AS job,
      CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'warn' ELSE 'info' END AS level,
      CASE WHEN user_id % 3 = 0 THEN concat('api-', CAST(user_id % 4 AS VARCHAR)) END AS pod,
      CAST(user_id % 2 + 1 AS VARCHAR) AS tenant
    FROM events
  )
)
"""


def doc_logs(spark: SparkSession, sf_dir: str, quality: bool = False) -> DataFrame:
    """Lines of ``documents``, one nanosecond apart, with labels lang, source and, if asked for, (sparse) quality."""
    names = ["lang", "source"]
    documents = read(spark, sf_dir, "documents")
    if quality:
        # Joined before the split into lines: whole documents are fewer rows to move.
        documents = documents.join(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
        names.append("quality")
    lines = F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")
    split = documents.select("doc_id", *names, lines).withColumn("line_no", F.col("line_no").cast("bigint"))
    return log_table(
        split.withMetadata("doc_id", counted_time(EPOCH_NS, NANOS_PER_SECOND)),
        ts_ns=F.lit(EPOCH_NS) + F.col("doc_id") * F.lit(NANOS_PER_SECOND) + F.col("line_no"),
        line=F.col("line"),
        labels={name: F.col(name) for name in names},
        keep=["doc_id", "line_no"],
    )


DOC_LOGS = """
doc_logs AS (
  SELECT t.doc_id, t.line_no, 1700000000000000000 + t.doc_id * 1000000000 + t.line_no AS ts_ns,
    t.line, t.lang, t.source, CAST(l.quality AS VARCHAR) AS quality
  FROM (
    SELECT doc_id, lang, source, CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS line_no, unnest(parts) AS line
    FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS parts FROM documents)
  ) t
  LEFT JOIN labels l ON l.doc_id = t.doc_id
)
"""


def conv_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as logs with label role; entries of the same turn share one instant."""
    conversations = read(spark, sf_dir, "conversations")
    return log_table(
        conversations,
        ts_ns=F.lit(EPOCH_NS) + F.col("turn") * F.lit(NANOS_PER_SECOND),
        line=F.col("text"),
        labels={"role": F.col("role")},
        metadata={"conv_id": F.col("conv_id"), "turn": F.col("turn")},
    )


CONV_LOGS = """
conv_logs AS (
  SELECT 1700000000000000000 + turn * 1000000000 AS ts_ns, text AS line, role, conv_id, turn,
    concat('{"role":"', role, '"}') AS labels_key
  FROM conversations
)
"""


def with_relations(*relations: str, select: str) -> str:
    return "WITH " + ", ".join(r.strip() for r in relations) + "\n" + select.strip()
