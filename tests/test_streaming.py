from __future__ import annotations

import json
from types import SimpleNamespace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from logframe import read_logs, scan_logs
from logframe.streaming import ingest_payloads, log_stream, payload_stream
from logframe.streaming.ingest import checkpoint_location

from tests.conftest import BASE_NS, SECOND


def payload(start, count, job="api"):
    values = [[str(BASE_NS + (start + i) * SECOND), f"entry {start + i}"] for i in range(count)]
    return json.dumps({"data": {"resultType": "streams", "result": [{"stream": {"job": job}, "values": values}]}})


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


def wait_for(spark, name):
    """Until the query of that name has ended."""
    for query in spark.streams.active:
        if query.name == name:
            run(query)


def test_payload_files_are_landed_once_and_followed(spark, tmp_path):
    inbox, table = tmp_path / "inbox", str(tmp_path / "logs")
    inbox.mkdir()
    (inbox / "a.json").write_text(payload(0, 3))
    (inbox / "bad.json").write_text("oops")
    arguments = {"name": "landing", "checkpoint": str(tmp_path / "progress"), "rejects": str(tmp_path / "rejects")}
    run(ingest_payloads(payload_stream(spark, str(inbox)), table, **arguments))
    wait_for(spark, "landing-rejects")
    assert [(r.reason, r.snippet) for r in spark.read.json(str(tmp_path / "rejects")).collect()] == [("not valid JSON", "oops")]
    (inbox / "b.json").write_text(payload(10, 2, job="web"))
    run(ingest_payloads(payload_stream(spark, str(inbox), files_per_batch=1), table, **arguments))
    landed = read_logs(spark, table)
    assert sorted(r.line for r in landed.collect()) == ["entry 0", "entry 1", "entry 10", "entry 11", "entry 2"]
    assert {"day", "labels_key"} <= set(landed.columns)

    # The predicates of a scan on the same table as a stream.
    followed = scan_logs(
        log_stream(spark, table), [("job", "=", "api")], line=[("not suffix", "1")], start=0, end=2**63 - 1, limit=None
    )
    assert followed.isStreaming
    query = (
        followed.select("line")
        .writeStream.format("memory")
        .queryName("followed")
        .option("checkpointLocation", str(tmp_path / "follow"))
        .trigger(availableNow=True)
        .start()
    )
    run(query)
    assert sorted(r.line for r in spark.table("followed").collect()) == ["entry 0", "entry 2"]


def test_a_bad_payload_fails_unless_rejects_are_kept(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "bad.json").write_text("oops")
    query = ingest_payloads(payload_stream(spark, str(inbox)), str(tmp_path / "logs"), name="strict", checkpoint=str(tmp_path / "progress"))
    with pytest.raises(StreamingQueryException, match="not valid JSON"):
        query.awaitTermination(120)


def test_tenants_are_laid_out(spark, tmp_path):
    inbox, table = tmp_path / "inbox", str(tmp_path / "logs")
    inbox.mkdir()
    (inbox / "t1.json").write_text(payload(0, 2))
    payloads = payload_stream(spark, str(inbox)).withColumn("tenant", F.lit("01"))
    run(ingest_payloads(payloads, table, name="tenants", checkpoint=str(tmp_path / "progress")))
    assert {r.tenant for r in read_logs(spark, table).collect()} == {"01"}
    assert (tmp_path / "logs" / "tenant=01").is_dir()


def test_checkpoint_folder_comes_from_the_session():
    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: settings.get(key.replace(".", "_"), default)))

    assert checkpoint_location(session(spark_checkpoint_dir="/shared/"), "landing") == "/shared/landing"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_location(session(), "landing")
