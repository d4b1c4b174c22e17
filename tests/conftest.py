from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from logframe import log_table  # noqa: E402
from logframe.model import PROMOTED  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def logs(spark):
    """Build a log table from ``(ts_ns, line, labels[, metadata])`` rows."""

    def build(rows, promote=()):
        rows = [(r[0], r[1], r[2], r[3] if len(r) > 3 else {}) for r in rows]
        schema = "ts_ns bigint, line string, labels map<string,string>, structured_metadata map<string,string>"
        df = spark.createDataFrame(rows, schema)
        table = log_table(
            df, ts_ns=F.col("ts_ns"), line=F.col("line"), labels=F.col("labels"), metadata=F.col("structured_metadata")
        )
        for name in promote:
            table = table.withColumn(name, F.col("labels")[name]).withMetadata(name, PROMOTED)
        return table

    return build


BASE_NS = 1_700_000_000_000_000_000
SECOND = 1_000_000_000


@pytest.fixture(scope="session")
def seeded(logs):
    """Eight entries of two jobs, one second apart."""
    rows = [
        ("shop", "info", "cart opened"),
        ("shop", "warn", "cart slow: 900 ms"),
        ("shop", "fatal", "payment refused by bank"),
        ("mail", "info", "queue empty"),
        ("shop", "fatal", "ledger locked"),
        ("mail", "info", "sent 3 letters"),
        ("mail", "warn", "letter bounced: bank"),
        ("shop", "info", "cart closed"),
    ]
    return logs(
        [(BASE_NS + i * SECOND, line, {"job": job, "level": level}) for i, (job, level, line) in enumerate(rows)]
    ).cache()


@pytest.fixture(scope="session")
def base_window():
    return {"start": BASE_NS - SECOND, "end": BASE_NS + 10 * SECOND}
