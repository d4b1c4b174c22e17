"""Captured JSON payloads: rendered from the tables by Spark, then parsed back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logframe import labels_key_of, parse_series, parse_streams, parse_string_array, payload_rejects, series
from logframe.functions.timebounds import NANOS_PER_SECOND
from logframe.model import canonical_map
from workload.registry import query
from workload.relations import CONV_LOGS, DOC_LOGS, EPOCH_NS, conv_logs, ev_logs, read, with_relations
from workload.scans import ev_sql


def _body(*parts) -> F.Column:
    return F.concat(*(F.lit(part) if isinstance(part, str) else part for part in parts)).alias("body")


def _streams_body(labels: F.Column, values: F.Column) -> F.Column:
    head = '{"status":"success","data":{"resultType":"streams","result":[{"stream":'
    return _body(head, canonical_map(labels), ',"values":', values, "}]}}")


def entry_payloads(logs: DataFrame) -> DataFrame:
    """One stream payload per log entry, with its metadata."""
    time_and_line = F.to_json(F.array(F.col("ts_ns").cast("string"), F.col("line")))
    metadata = F.concat(F.lit(',{"structuredMetadata":'), F.to_json("structured_metadata"), F.lit("}]]"))
    values = F.concat(F.lit("["), F.rtrim(time_and_line, F.lit("]")), metadata)
    return logs.select(_streams_body(F.col("labels"), values))


def _document_payloads(documents: DataFrame) -> DataFrame:
    """One stream payload per document: its lines as entries, one nanosecond apart."""
    first = F.lit(EPOCH_NS) + F.col("doc_id") * F.lit(NANOS_PER_SECOND)
    entries = F.transform(
        F.split("text", "\n", -1), lambda line, i: F.array((first + i).cast("string"), line)
    )
    labels = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    return documents.select(_streams_body(labels, F.to_json(entries)))


@query("parse_streams", with_relations(CONV_LOGS, select="SELECT role, ts_ns, line, conv_id, turn FROM conv_logs"))
def streams(spark, sf_dir) -> DataFrame:
    metadata = F.col("structured_metadata")
    return parse_streams(entry_payloads(conv_logs(spark, sf_dir))).select(
        F.col("labels")["role"].alias("role"),
        "ts_ns",
        "line",
        metadata["conv_id"].cast("bigint").alias("conv_id"),
        metadata["turn"].cast("bigint").alias("turn"),
    )


@query("parse_streams_entries", with_relations(DOC_LOGS, select="SELECT lang, source, ts_ns, line FROM doc_logs"))
def streams_of_many_entries(spark, sf_dir) -> DataFrame:
    labels = F.col("labels")
    return parse_streams(_document_payloads(read(spark, sf_dir, "documents"))).select(
        labels["lang"].alias("lang"), labels["source"].alias("source"), "ts_ns", "line"
    )


@query(
    "parse_streams_mixed",
    with_relations(
        CONV_LOGS,
        select="SELECT role, ts_ns, line, CASE WHEN turn % 2 = 1 THEN conv_id END AS conv_id FROM conv_logs",
    ),
)
def streams_of_mixed_entries(spark, sf_dir) -> DataFrame:
    """Up to sixteen turns as one payload: odd ones with metadata, even ones without; names stand twice in both."""
    logs = conv_logs(spark, sf_dir).withColumn("conv", F.col("structured_metadata")["conv_id"]).withColumn("turn", F.col("structured_metadata")["turn"].cast("bigint"))
    plain = F.to_json(F.array(F.col("ts_ns").cast("string"), F.col("line")))
    third = F.concat(F.lit(',{"parsed":{"n":"1","n":"2"},"structuredMetadata":{"conv_id":"'), "conv", F.lit('","conv_id":"0"}}]'))
    entry = F.when(F.col("turn") % 2 == 1, F.concat(F.rtrim(plain, F.lit("]")), third)).otherwise(plain)
    grouped = logs.select("conv", F.col("labels")["role"].alias("role"), "turn", entry.alias("entry"))
    grouped = grouped.groupBy("conv", "role", F.floor(F.col("turn") / 16))
    values = grouped.agg(F.array_join(F.collect_list("entry"), ",").alias("values"))
    labels = F.concat(F.lit('{"role":'), F.get(F.split(F.to_json(F.struct("role")), ":", 2), F.lit(1)))
    head = '{"status":"success","data":{"resultType":"streams","result":[{"stream":'
    body = _body(head, F.concat(F.rtrim(labels, F.lit("}")), F.lit(',"role":"other"}')), ',"values":[', F.col("values"), "]}]}}")
    return parse_streams(values.select(body)).select(
        F.col("labels")["role"].alias("role"), "ts_ns", "line", F.col("structured_metadata")["conv_id"].cast("bigint").alias("conv_id")
    )


@query("parse_string_array", with_relations(DOC_LOGS, select="SELECT line AS value FROM doc_logs"))
def string_array(spark, sf_dir) -> DataFrame:
    """One payload per document: its lines, followed by elements that are not strings."""
    lines = F.to_json(F.split("text", "\n", -1))
    odd = F.concat(F.rtrim(lines, F.lit("]")), F.lit(',5,null,["x"],true]'))
    payloads = read(spark, sf_dir, "documents").select(_body('{"status":"success","data":', odd, "}"))
    return parse_string_array(payloads)


@query("parse_series", ev_sql("SELECT DISTINCT labels_key FROM ev_logs WHERE job <> ''"))
def parsed_series(spark, sf_dir) -> DataFrame:
    found = series(ev_logs(spark, sf_dir), [("job", "=~", ".+")])
    payloads = found.select(_body('{"status":"success","data":[', F.to_json("labels"), ',{"n":5}]}'))
    parsed = parse_series(payloads).where(F.size("labels") > 0)
    return parsed.select(labels_key_of(parsed).alias("labels_key"))


@query(
    "payload_rejects",
    """
    SELECT CASE conv_id % 4 WHEN 0 THEN 'not valid JSON' WHEN 1 THEN 'missing data' ELSE 'resultType is matrix' END
      AS reason, count(*) AS payloads
    FROM conversations WHERE conv_id % 4 < 3 GROUP BY 1
    """,
)
def rejects(spark, sf_dir) -> DataFrame:
    """Error texts, error objects, metric results and good payloads, one per turn of a conversation."""
    text = F.to_json(F.struct(F.col("text").alias("message")))
    good = ('{"data":{"resultType":"streams","result":[{"stream":{"role":"', F.col("role"), '"},"values":[]}]}}')
    body = (
        F.when(F.col("conv_id") % 4 == 0, F.concat(F.lit("error: "), F.col("text")))
        .when(F.col("conv_id") % 4 == 1, text)
        .when(F.col("conv_id") % 4 == 2, _body('{"data":{"resultType":"matrix","result":[', text, "]}}"))
        .otherwise(_body(*good))
    )
    payloads = read(spark, sf_dir, "conversations").select("conv_id", body.alias("body"))
    return payload_rejects(payloads).groupBy("reason").agg(F.count("*").alias("payloads"))
