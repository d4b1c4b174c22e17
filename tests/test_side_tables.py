"""Tables at rest with side tables: label sets, the text index, batches, compaction, scans by label set."""

from __future__ import annotations

import os
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from logframe import attach, compact_logs, indexed_series, label_names, label_values, land_batch, log_table, read_logs, refresh_index, refresh_text_index, scan_logs, scan_table, series, write_logs
from logframe.plans import formatted_plan, plan_facts
from logframe.sources import series_index, tables, text_index

DAY = 86_400 * 10**9
START = 19_700 * DAY
WINDOW = {"start": START, "end": START + 30 * DAY}


def entries(spark, low, high, job="api", per_day=100, tenants=True):
    """Entries ``low`` to ``high``, so many a day, with sparse labels that are not all promoted."""
    n = F.col("id")
    labels = F.map_filter(
        F.create_map(F.lit("job"), F.lit(job), F.lit("pod"), F.when(n % 4 == 0, F.concat(F.lit("p-"), (n % 8).cast("string"))), F.lit("zone"), F.when(n % 7 == 0, F.lit("z"))),
        lambda _, v: v.isNotNull(),
    )
    line = F.concat(F.lit("entry "), n.cast("string"), F.when(n % 50 == 0, F.concat(F.lit(" needle "), n.cast("string"))).otherwise(""))
    df = spark.range(low, high)
    return log_table(df, ts_ns=F.lit(START) + n * (DAY // per_day), line=line, labels=labels, metadata={"n": n}, tenant=F.when(n % 3 == 0, "007").otherwise("blue") if tenants else None)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Thirty days in three batches, indexed."""
    path = str(tmp_path_factory.mktemp("side") / "logs")
    land_batch(entries(spark, 0, 1500), path, "b1")
    land_batch(entries(spark, 1500, 2800, "web"), path, "b2")
    land_batch(entries(spark, 2800, 3000), path, "b3")
    refresh_index(spark, path)
    refresh_text_index(spark, path)
    return path


def found(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def counts(df):
    return {(r.tenant, str(r.day), r.labels_key): r.n for r in df.groupBy("tenant", "day", "labels_key").agg(F.sum("entries").alias("n") if "entries" in df.columns else F.count("*").alias("n")).collect()}


# Label sets -------------------------------------------------------------------------


def test_side_table_holds_what_the_table_holds(spark, stored):
    assert series_index.stale_units(spark, stored) == [] and refresh_index(spark, stored) == []
    assert counts(indexed_series(spark, stored)) == counts(read_logs(spark, stored))


@pytest.mark.parametrize("low, high", [(0, 30 * DAY), (3 * DAY + 5, 9 * DAY - 7), (2 * DAY + DAY // 2, 2 * DAY + DAY // 2 + DAY // 10), (DAY // 100 + 1, DAY // 100 + 2), (-5, 0), (29 * DAY, 60 * DAY)])
def test_discovery_in_windows_equals_that_of_the_table(spark, stored, low, high):
    window = {"start": START + low, "end": START + high}
    known, logs = indexed_series(spark, stored, **window), read_logs(spark, stored)
    assert found(label_names(known), "label") == found(label_names(logs, **window), "label")
    assert found(label_values(known, "pod", selector=[("job", "=", "api")]), "value") == found(label_values(logs, "pod", selector=[("job", "=", "api")], **window), "value")
    keys = lambda df: found(df.select(F.to_json("labels").alias("k")), "k")
    assert keys(series(known, [("job", "=~", "a.*|web")])) == keys(series(logs, [("job", "=~", "a.*|web")], **window))


def test_discovery_does_not_scan_the_table(spark, stored):
    db = attach(spark, stored, "indexed", tenants=["007", "blue"])
    assert db.labels == {"007": ["job", "pod", "zone"], "blue": ["job", "pod", "zone"]}
    known = indexed_series(spark, stored)
    for df in (db.table(spark, "labels"), db.table(spark, "series", "blue"), label_names(known), series(known, [("job", "=", "api")])):
        assert "ts_ns" not in formatted_plan(df) and all("labels:map" not in schema for schema in plan_facts(df)["ReadSchema"])
    plain = attach(spark, read_logs(spark, stored), "scanned", tenants=["007", "blue"])
    assert plain.labels == db.labels
    for tenant in db.tenants:
        for table, columns in (("labels", ["label"]), ("series", ["job", "pod", "zone"])):
            assert found(db.table(spark, table, tenant), *columns) == found(plain.table(spark, table, tenant), *columns)


def test_lost_and_repeated_batches(spark, tmp_path):
    path = str(tmp_path / "logs")
    land_batch(entries(spark, 0, 200), path, "b1")
    refresh_index(spark, path)
    land_batch(entries(spark, 200, 400, "web"), path, "b2")  # its rows of the side table are lost
    assert counts(indexed_series(spark, path)) == counts(read_logs(spark, path))
    land_batch(entries(spark, 200, 400, "web"), path, "b2")  # and the batch is run again
    assert read_logs(spark, path).count() == 400
    assert len(refresh_index(spark, path)) == 4
    land_batch(entries(spark, 0, 200, "new"), path, "b1")
    assert counts(indexed_series(spark, path)) == counts(read_logs(spark, path)) and refresh_index(spark, path)
    assert found(label_values(indexed_series(spark, path), "job"), "value") == {("new",): 1, ("web",): 1}
    refresh_index(spark, path, rebuild=True)
    assert counts(indexed_series(spark, path)) == counts(read_logs(spark, path))


def test_tables_without_tenants_or_batches(spark, tmp_path):
    path = str(tmp_path / "plain")
    write_logs(entries(spark, 0, 300, tenants=False), path)
    with pytest.raises(ValueError, match="refresh_index"):
        scan_table(spark, path, '{job="api"}', **WINDOW)
    assert len(refresh_index(spark, path)) == 3 and refresh_index(spark, path) == []
    assert found(label_names(indexed_series(spark, path)), "label") == {("job",): 1, ("pod",): 1, ("zone",): 1}
    write_logs(entries(spark, 300, 400, tenants=False), path, mode="append")
    assert len(series_index.stale_units(spark, path)) == 1
    assert indexed_series(spark, path).agg(F.sum("entries")).first()[0] == 400
    assert scan_table(spark, path, '{job="api"}', limit=None, **WINDOW).count() == 400


# Scans by label set -----------------------------------------------------------------

SELECTORS = [
    '{job="api"}',
    '{job=~"a.i|none", pod=~"p-[04]"}',
    '{job=~".+", pod!~"p-.*", zone="z"}',
    '{job="web", zone!="z"} |= "needle"',
    '{job=~"api|web"} |~ "needle [0-9]*50$" != "entry 1"',
    '{job="none"}',
]


@pytest.mark.parametrize("text", SELECTORS)
def test_scan_by_label_set_equals_the_scan(spark, stored, text):
    logs, columns = read_logs(spark, stored), ("ts_ns", "line", "pod", "zone")
    want = found(scan_logs(logs, text, labels=["pod", "zone"], limit=None, **WINDOW), *columns)
    assert found(scan_table(spark, stored, text, labels=["pod", "zone"], limit=None, **WINDOW), *columns) == want
    for direction in ("backward", "forward"):
        limited = [scan.select("ts_ns", "line").collect() for scan in (scan_logs(logs, text, limit=9, direction=direction, **WINDOW), scan_table(spark, stored, text, limit=9, direction=direction, **WINDOW))]
        assert limited[0] == limited[1]


def test_many_label_sets_are_joined(spark, stored, monkeypatch):
    from logframe.operators import table_scan

    monkeypatch.setattr(table_scan, "LISTED", 2)
    text = SELECTORS[2].replace(', zone="z"', "")
    scan = scan_table(spark, stored, text, limit=None, **WINDOW)
    assert "LeftSemi" in formatted_plan(scan)
    assert found(scan, "ts_ns", "line") == found(scan_logs(read_logs(spark, stored), text, limit=None, **WINDOW), "ts_ns", "line")


def test_entries_are_chosen_by_number_alone(spark, stored):
    scan = scan_table(spark, stored, '{job=~"a.i", pod=~"p-[04]"}', limit=None, tenant="blue", **WINDOW).select("line")
    facts, plan = plan_facts(scan), formatted_plan(scan)
    assert any("stream_id" in pushed for pushed in facts["PushedFilters"])
    assert "RLIKE" not in plan and all("map" not in schema for schema in facts["ReadSchema"])
    assert any("blue" in part for part in facts["PartitionFilters"])


def test_all_labels_become_columns(spark, stored):
    scan = scan_table(spark, stored, '{job="web"}', labels="*", limit=None, **WINDOW)
    assert scan.columns == ["timestamp", "ts_ns", "line", "job", "pod", "zone", "labels", "structured_metadata"]
    assert scan.where("pod IS NOT NULL").count() == 1300 // 4 and scan.where("zone = 'z'").count() > 0
    none = scan_table(spark, stored, '{job="none"}', labels="*", **WINDOW)
    assert none.columns == ["timestamp", "ts_ns", "line", "labels", "structured_metadata"] and none.count() == 0
    with pytest.raises(ValueError):
        scan_logs(read_logs(spark, stored), '{job="web"}', labels="*")


# Limits by day ----------------------------------------------------------------------


@pytest.mark.parametrize("direction, day", [("backward", 29), ("forward", 0)])
def test_a_limit_met_on_one_day_reads_that_day(spark, stored, direction, day):
    scan = scan_logs(read_logs(spark, stored), [("job", "=", "api")], limit=40, direction=direction, **WINDOW)
    days = {r.day for r in scan.select(F.to_date("timestamp").cast("string").alias("day")).collect()}
    (want,) = spark.sql(f"SELECT cast(date_from_unix_date({START // DAY + day}) AS string)").first()
    assert days == {want}
    assert any(f"day {sign} {want}" in part or (sign in part and want in part) for part in plan_facts(scan)["PartitionFilters"] for sign in (">=", "<="))


def test_limits_that_reach_over_empty_days(spark, stored):
    logs = read_logs(spark, stored)
    # the last entries of web lie on day 27: groups of 1, 2 and 4 days are counted
    got = scan_logs(logs, [("job", "=", "web")], limit=150, **WINDOW)
    assert [r.ts_ns for r in got.collect()] == [START + n * (DAY // 100) for n in range(2799, 2649, -1)]
    assert scan_logs(logs, [("job", "=", "web")], limit=5000, **WINDOW).count() == 1300
    assert scan_logs(logs, [("job", "=", "web")], limit=5000, direction="forward", **WINDOW).count() == 1300
    assert scan_logs(logs, [("job", "=", "none")], limit=5, **WINDOW).count() == 0


# Batches and compaction -------------------------------------------------------------


def test_files_of_a_batch_do_not_overlap_in_time(spark, tmp_path):
    path = str(tmp_path / "logs")
    shuffled = entries(spark, 0, 400, tenants=False).orderBy(F.rand(3))
    land_batch(shuffled, path, "b1", partitions=8)
    spans = read_logs(spark, path).groupBy(F.input_file_name().alias("f")).agg(F.min("ts_ns").alias("a"), F.max("ts_ns").alias("b")).orderBy("a").collect()
    assert len(spans) >= 8 and all(x.b < y.a for x, y in zip(spans, spans[1:]))


@pytest.mark.parametrize("name", ["a/b", "", "a b", "compacted", "a=b"])
def test_batch_names(spark, tmp_path, name):
    with pytest.raises(ValueError, match="batch"):
        land_batch(entries(spark, 0, 1), str(tmp_path / "logs"), name)


def test_compaction_keeps_rows_and_side_tables(spark, tmp_path):
    path = str(tmp_path / "logs")
    for k in range(4):
        land_batch(entries(spark, 50 * k, 50 * k + 150), path, f"b{k}")
    refresh_index(spark, path)
    before, files = found(read_logs(spark, path), "ts_ns", "line", "tenant"), len(list(Path(path).rglob("*.parquet")))
    places = compact_logs(spark, path, days=["2023-12-09", "2023-12-10"])
    assert len(places) == 4 and compact_logs(spark, path, days=["2023-12-09"]) == []
    assert found(read_logs(spark, path), "ts_ns", "line", "tenant") == before
    assert {p.name for p in Path(path).glob("tenant=*/day=2023-12-10/*")} == {"batch=compacted"}
    assert not os.path.exists(f"{path}/_staged") and len(list(Path(path).rglob("day=*/batch=*/*.parquet"))) < files
    assert counts(indexed_series(spark, path)) == counts(read_logs(spark, path))
    assert len(refresh_index(spark, path)) == 4


def test_an_interrupted_compaction_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "logs")
    for k in range(2):
        land_batch(entries(spark, 0, 150, job=f"j{k}"), path, f"b{k}")
    before, real, calls = found(read_logs(spark, path), "ts_ns", "line", "labels_key"), tables.move, []

    def broken(spark, source, to):
        calls.append(to)
        if len(calls) == 2:
            raise OSError("lost")
        real(spark, source, to)

    monkeypatch.setattr(tables, "move", broken)
    with pytest.raises(OSError):
        compact_logs(spark, path)
    monkeypatch.setattr(tables, "move", real)
    compact_logs(spark, path)
    assert found(read_logs(spark, path), "ts_ns", "line", "labels_key") == before
    # one that did not finish writing is dropped
    land_batch(entries(spark, 0, 50), f"{path}/_staged/files", "half")
    compact_logs(spark, path)
    assert found(read_logs(spark, path), "ts_ns", "line", "labels_key") == before and not os.path.exists(f"{path}/_staged")


# The text index ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    """A file a day, each with words of its own, odd lines among them."""
    drawn = random.Random(4)
    rows = []
    for day in range(8):
        words = ["".join(drawn.choice("abcdefgh") for _ in range(6)) for _ in range(30)] + ["é🙂ü", "ab", "", "x\r\ny"]
        rows += [(START + day * DAY + k, " ".join(drawn.choice(words) for _ in range(4)), day) for k in range(60)]
    rows.append((START + 5 * DAY + 999, "the only needle", 5))
    df = log_table(spark.createDataFrame(rows, "t long, l string, d int"), ts_ns=F.col("t"), line=F.col("l"), labels={"job": F.lit("a")})
    path = str(tmp_path_factory.mktemp("texts") / "logs")
    write_logs(df, path, partitions=8)
    refresh_index(spark, path)
    assert refresh_text_index(spark, path) >= 8 and refresh_text_index(spark, path) == 0
    return path, [r[1] for r in rows]


def test_a_rare_literal_reads_the_files_that_may_hold_it(spark, texts):
    path, _ = texts
    assert len(text_index.files_with(spark, path, ["only needle"])) == 1
    assert text_index.files_with(spark, path, ["qqqqqq"]) == [] and text_index.files_with(spark, path, ["ab"]) is None and text_index.files_with(spark, path, []) is None
    scan = scan_table(spark, path, '{job="a"} |= "only needle"', limit=None, **WINDOW)
    assert [r.line for r in scan.collect()] == ["the only needle"] and len(scan.inputFiles()) == 1
    assert scan_table(spark, path, '{job="a"} |~ "zz+qq.*"', limit=None, **WINDOW).count() == 0


def test_no_line_is_lost(spark, texts):
    path, lines = texts
    drawn = random.Random(7)
    for _ in range(12):
        line = drawn.choice([l for l in lines if len(l) > 8])
        at = drawn.randrange(len(line) - 3)
        part = line[at : at + drawn.randrange(3, 9)]
        scan = scan_table(spark, path, [("job", "=", "a")], line=[("contains", part)], limit=None, **WINDOW)
        assert Counter(r.line for r in scan.collect()) == Counter(l for l in lines if part in l)


def test_unknown_files_are_read(spark, tmp_path):
    path = str(tmp_path / "logs")
    land_batch(entries(spark, 0, 100), path, "b1")
    refresh_index(spark, path)
    refresh_text_index(spark, path)
    land_batch(entries(spark, 100, 200), path, "b2")
    assert scan_table(spark, path, '{job="api"} |= "needle 150"', limit=None, **WINDOW).count() == 1
    assert text_index.literals_of([("regex", "a+needle.*x"), ("not contains", "gone"), ("prefix", "ab"), ("suffix", "tail")])[-1] == "tail"


def test_a_look_up_reads_few_blocks(spark, texts):
    path, _ = texts
    rows = spark.read.parquet(text_index.text_index_path(path))
    asked = text_index._asked(["only needle"])
    assert 0 < len(asked) <= 9 and rows.where(F.col("block").isin(list(asked))).count() < rows.count() / 4
    assert rows.where(F.length("grams") > text_index.BLOCK).count() == 0


def test_write_tasks_follow_the_size(spark, monkeypatch):
    df = spark.range(1_000_000)
    assert tables.write_tasks(df) is None
    monkeypatch.setattr(tables, "TASK_BYTES", 100_000)
    assert tables.write_tasks(df) == 80
    monkeypatch.setattr(tables, "MOST_TASKS", 10)
    assert tables.write_tasks(df) is None


def test_folders_are_named_per_file_and_not_per_entry(spark, tmp_path, monkeypatch):
    path, plans = str(tmp_path / "logs"), []
    land_batch(entries(spark, 0, 400), path, "b1", partitions=20)
    counted = series_index.counted_series
    monkeypatch.setattr(series_index, "counted_series", lambda df, *keys: plans.append(formatted_plan(counted(df, *keys))) or counted(df, *keys))
    refresh_index(spark, path)
    assert len(plans) == 1 and "regexp_replace" not in plans[0]
    rows = spark.read.parquet(series_index.index_path(path))
    assert rows.count() == rows.select("unit", "tenant", "day", "labels_key").distinct().count()
    assert rows.select("unit").distinct().count() < len(list(Path(path).rglob("batch=*/*.parquet")))
    assert counts(indexed_series(spark, path)) == counts(read_logs(spark, path))
