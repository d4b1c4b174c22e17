"""Streams that land, follow and merge: repeated batches, tails, pages as files."""

from __future__ import annotations

import json
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from logframe import compact_logs, indexed_series, land_batch, log_table, merge_pages, read_logs, refresh_index
from logframe.sources.series_index import stale_units
from logframe.streaming import ingest_payloads, log_stream, merge_pages_stream, payload_stream, tail_logs
from logframe.streaming import ingest, pages as pages_module
from tests.conftest import BASE_NS, SECOND
from tests.test_streaming import payload, run


def lines(df):
    return sorted(r.line for r in df.collect())


# Ingest -----------------------------------------------------------------------------


def test_a_batch_that_fails_after_writing_is_repeated_once(spark, tmp_path, monkeypatch):
    inbox, table = tmp_path / "inbox", str(tmp_path / "logs")
    inbox.mkdir()
    (inbox / "a.json").write_text(payload(0, 3))
    arguments = {"name": "killed", "checkpoint": str(tmp_path / "progress"), "rejects": str(tmp_path / "rejects")}
    run(ingest_payloads(payload_stream(spark, str(inbox)), table, **arguments))
    (inbox / "b.json").write_text(payload(3, 4))
    (inbox / "bad.json").write_text("oops")

    def lost(*_):
        raise OSError("lost before the batch was committed")

    monkeypatch.setattr(ingest, "refresh_index", lost)
    query = ingest_payloads(payload_stream(spark, str(inbox)), table, **arguments)
    with pytest.raises(StreamingQueryException):
        query.awaitTermination(120)
    monkeypatch.undo()
    assert len(stale_units(spark, table)) == 1  # written, but not in the side table
    run(ingest_payloads(payload_stream(spark, str(inbox)), table, **arguments))
    assert lines(read_logs(spark, table)) == sorted(f"entry {k}" for k in range(7))
    assert stale_units(spark, table) == [] and indexed_series(spark, table).agg(F.sum("entries")).first()[0] == 7
    assert [r.snippet for r in spark.read.json(str(tmp_path / "rejects")).collect()] == ["oops"]


def test_rejects_fail_with_the_query(spark, tmp_path, monkeypatch):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "bad.json").write_text("oops")
    (inbox / "good.json").write_text(payload(0, 2))
    (tmp_path / "rejects").write_text("a file where the folder should be")
    query = ingest_payloads(payload_stream(spark, str(inbox)), str(tmp_path / "logs"), name="unwritable", checkpoint=str(tmp_path / "progress"), rejects=str(tmp_path / "rejects"))
    with pytest.raises(StreamingQueryException):
        query.awaitTermination(120)
    assert not (tmp_path / "logs").exists()  # nothing landed that would hide the loss


def test_batches_of_two_streams_do_not_replace_each_other(spark, tmp_path):
    table = str(tmp_path / "logs")
    for k in range(2):
        inbox = tmp_path / f"inbox{k}"
        inbox.mkdir()
        (inbox / "a.json").write_text(payload(10 * k, 2))
        run(ingest_payloads(payload_stream(spark, str(inbox)), table, name=f"stream{k}", checkpoint=str(tmp_path / f"progress{k}")))
    assert lines(read_logs(spark, table)) == ["entry 0", "entry 1", "entry 10", "entry 11"]


def test_landed_files_of_a_day_do_not_overlap_within_a_batch(spark, tmp_path):
    inbox, table = tmp_path / "inbox", str(tmp_path / "logs")
    inbox.mkdir()
    for k in random.Random(1).sample(range(30), 30):
        (inbox / f"{k}.json").write_text(payload(20 * k, 20))
    run(ingest_payloads(payload_stream(spark, str(inbox)), table, name="ranged", checkpoint=str(tmp_path / "progress"), partitions=6))
    spans = read_logs(spark, table).groupBy(F.input_file_name().alias("f")).agg(F.min("ts_ns").alias("a"), F.max("ts_ns").alias("b")).orderBy("a").collect()
    assert len(spans) >= 5 and all(x.b < y.a for x, y in zip(spans, spans[1:]))


# Tail -------------------------------------------------------------------------------


def entries(spark, low, high, job="api"):
    n = F.col("id")
    return log_table(spark.range(low, high), ts_ns=F.lit(BASE_NS) + n * F.lit(SECOND), line=F.concat(F.lit("l"), n.cast("string")), labels={"job": F.lit(job)}, metadata={"n": n})


def test_tail_follows_with_a_limit_and_goes_on(spark, tmp_path):
    path, seen = str(tmp_path / "logs"), []
    land_batch(entries(spark, 0, 10), path, "b0")

    def follow(**more):
        arguments = {"name": "tail", "line": [("not contains", "7")], "labels": ["job"], "start": BASE_NS + 2 * SECOND, "checkpoint": str(tmp_path / "progress"), **more}
        run(tail_logs(log_stream(spark, path), [("job", "=", "api")], lambda df, number: seen.append((number, [(r.line, r.job) for r in df.collect()])), **arguments))

    follow(limit=3)
    assert seen == [(0, [("l9", "api"), ("l8", "api"), ("l6", "api")])]
    land_batch(entries(spark, 10, 20), path, "b1")
    land_batch(entries(spark, 20, 25, "web"), path, "b2")
    follow(limit=2, direction="forward")
    assert seen[1:] == [(1, [("l10", "api"), ("l11", "api")])]
    compact_logs(spark, path)
    follow(limit=None)
    assert [x for _, rows in seen[2:] for x in rows] == []  # compacted entries are not new
    land_batch(entries(spark, 30, 32), path, "b3")
    follow(limit=None)
    assert sorted(x for _, rows in seen[2:] for x in rows) == [("l30", "api"), ("l31", "api")]
    refresh_index(spark, path)
    assert read_logs(spark, path).count() == 27


def test_tail_refuses_bad_arguments(spark, tmp_path):
    path = str(tmp_path / "logs")
    land_batch(entries(spark, 0, 1), path, "b0")
    stream = log_stream(spark, path)
    for logs, selector, more in ((read_logs(spark, path), [("job", "=", "a")], {}), (stream, [], {}), (stream, [("job", "=", "a")], {"limit": 0}), (stream, [("job", "=", "a")], {"direction": "up"})):
        with pytest.raises(ValueError):
            tail_logs(logs, selector, print, name="bad", checkpoint=str(tmp_path / "p"), **more)


# Pages ------------------------------------------------------------------------------

PAGE = "ts bigint, l string, ls map<string,string>, m map<string,string>, page_id string"


def page_table(df):
    return log_table(df, ts_ns=F.col("ts"), line=F.col("l"), labels=F.col("ls"), metadata=F.col("m"), keep=["page_id"])


def counted(df):
    return Counter((r.ts_ns, r.line, tuple(sorted(r.labels.items()))) for r in df.select("ts_ns", "line", "labels").collect())


def arrive(spark, folder, pages, tmp_path, delay, name):
    """Each page as files of their own, in order; the merged rows and the states left after each run."""
    out, progress, states = str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-progress"), []
    for k, rows in enumerate(pages):
        half = len(rows) // 2
        for part in (rows[:half], rows[half:]):
            spark.createDataFrame(part, PAGE).coalesce(1).write.mode("append").parquet(folder)
        stream = merge_pages_stream(page_table(spark.readStream.schema(PAGE).option("maxFilesPerTrigger", 1).parquet(folder)), delay)
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).trigger(availableNow=True).start()
        run(query)
        states.append([p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1])
    return spark.read.parquet(out), states


def test_pages_that_arrive_give_the_merged_rows(spark, tmp_path):
    drawn = random.Random(2)
    pages = []
    for k in range(4):
        page = [(BASE_NS + drawn.randrange(12) * SECOND + drawn.randrange(2), drawn.choice(["up", "down"]), {"job": drawn.choice("ab")}, {"at": str(k)}, f"p{k}") for _ in range(60)]
        pages.append(page + page[:5])
    merged, _ = arrive(spark, str(tmp_path / "in"), pages, tmp_path, "1 hour", "all")
    assert counted(merged) == counted(merge_pages(page_table(spark.createDataFrame([r for p in pages for r in p], PAGE))))
    assert all(r.structured_metadata["at"] in "0123" for r in merged.collect())


def test_what_is_kept_does_not_grow(spark, tmp_path):
    """Every page repeats the end of the one before; entries older than the delay are forgotten."""
    pages = [[(BASE_NS + (20 * k + i) * SECOND, f"l{20 * k + i}", {"job": "a"}, {}, f"p{k}") for i in range(25)] for k in range(5)]
    merged, states = arrive(spark, str(tmp_path / "in"), pages, tmp_path, "30 seconds", "bounded")
    assert counted(merged) == Counter((BASE_NS + n * SECOND, f"l{n}", (("job", "a"),)) for n in range(105))
    assert max(states) <= 60 and states[-1] < 105


def test_entries_are_kept_in_groups(spark, tmp_path):
    """Many entries of one instant are few states, each one call of Python a batch."""
    pages = [[(BASE_NS, f"l{n}", {"job": "a"}, {}, f"p{k}") for n in range(700 * k, 700 * k + 1400)] for k in range(2)]
    merged, states = arrive(spark, str(tmp_path / "in"), pages, tmp_path, "1 hour", "grouped")
    assert counted(merged) == Counter((BASE_NS, f"l{n}", (("job", "a"),)) for n in range(2100))
    assert max(states) <= pages_module.GROUPS


def test_entries_of_one_group_are_forgotten_one_by_one(spark, tmp_path, monkeypatch):
    """Copies count across files, and what is older than the delay leaves a group that goes on."""
    monkeypatch.setattr(pages_module, "GROUPS", 1)
    pages = [[(BASE_NS + (20 * k + i) * SECOND, f"l{20 * k + i}", {"job": "a"}, {}, f"p{k}") for i in range(25) for _ in range(1 + i % 2)] for k in range(4)]
    merged, states = arrive(spark, str(tmp_path / "in"), pages, tmp_path, "30 seconds", "one")
    table = page_table(spark.createDataFrame([r for p in pages for r in p], PAGE))
    assert counted(merged) == counted(merge_pages(table)) and max(states) == 1

    class State:
        def __init__(self, text, timed_out, passed):
            self.text, self.hasTimedOut, self.passed, self.timeout = text, timed_out, passed, None
            self.getCurrentWatermarkMs, self.setTimeoutTimestamp = lambda: passed, lambda at: setattr(self, "timeout", at)

        exists = property(lambda self: self.text is not None)
        get = property(lambda self: (self.text,))

        def update(self, value):
            self.text = value[0]

        def remove(self):
            self.text = None

    rows = pd.DataFrame({"entry": ["a", "b", "a", "a"], "instant": [5, 9, 5, 5], "page": ["p", "p", "q", "p"], "ts_ns": 0, "line": list("wxyz"), "labels_key": "{}", "metadata": "{}"})
    state = State(None, False, 0)
    out = list(pages_module._new_copies((0,), [rows.iloc[:2], rows.iloc[2:]], state))
    assert [line for frame in out for line in frame["line"]] == ["w", "x", "z"] and state.timeout == 6
    state = State(state.text, True, 7)
    assert list(pages_module._new_copies((0,), [], state)) == [] and list(json.loads(state.text)) == ["b"] and state.timeout == 10
    state = State(state.text, True, 10)
    assert list(pages_module._new_copies((0,), [], state)) == [] and not state.exists
