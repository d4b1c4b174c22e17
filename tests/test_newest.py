from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from logframe import Window, newest, read_logs, write_logs
from logframe.operators import topk
from logframe.plans import formatted_plan

TIMES = {
    "spread": "id * 1000003",
    "one bucket holds a third": "if(id % 3 = 0, 500000000 + id, id * 1000003)",
    "one instant holds a third": "if(id % 3 = 0, 777, id * 1000003)",
    "one instant": "7",
    "negative": "(id - 1000) * 31",
}


def table(spark, time):
    return spark.range(3000).repartition(7).select(
        F.expr(f"cast({time} as bigint)").alias("ts_ns"),
        F.concat(F.lit("line "), (F.col("id") % 50).cast("string")).alias("line"),
        F.create_map(F.lit("job"), (F.col("id") % 5).cast("string")).alias("labels"),
        F.create_map(F.lit("id"), F.col("id").cast("string")).alias("structured_metadata"),
    )


def ordered(df, backward):
    """What brute force makes of it: time, then labels, line and metadata."""
    rows = [(r.ts_ns, json.dumps(r.labels, separators=(",", ":")), r.line, json.dumps(r.structured_metadata, separators=(",", ":"))) for r in df.collect()]
    return sorted(rows, reverse=backward)


@pytest.mark.parametrize("name", TIMES)
def test_first_rows_equal_brute_force(spark, name):
    df = table(spark, TIMES[name]).cache()
    lowest, highest = df.agg(F.min("ts_ns"), F.max("ts_ns")).first()
    middle = (lowest + highest) // 2
    for direction in ("backward", "forward"):
        every = ordered(df, direction == "backward")
        for window in (Window(), Window(middle, highest + 1)):
            low = window.start_ns if window.start_ns is not None else lowest
            high = window.end_ns if window.end_ns is not None else highest + 1
            inside = [r for r in every if low <= r[0] < high]
            for n in (40, 5000) if window == Window() else (40,):
                assert ordered_as_found(newest(df, n, direction, window)) == inside[:n]
    df.unpersist()


def ordered_as_found(df):
    return [(r.ts_ns, json.dumps(r.labels, separators=(",", ":")), r.line, json.dumps(r.structured_metadata, separators=(",", ":"))) for r in df.collect()]


def test_empty_input(spark):
    df = table(spark, "id").where("ts_ns < 0")
    assert newest(df, 5).collect() == []
    assert newest(df, 5, window=Window(0, 10)).collect() == []


def test_rows_without_a_time_take_no_part(spark):
    df = table(spark, "if(id % 2 = 0, null, id)")
    for direction in ("backward", "forward"):
        assert newest(df, 5000, direction).where("ts_ns is null").count() == 0
        assert newest(df, 5000, direction).count() == 1500
    assert [r.ts_ns for r in newest(df, 20, window=Window(5, 8)).collect()] == [7, 5]


def test_the_cut_off_leaves_little_for_the_last_step(spark):
    df = table(spark, TIMES["spread"])
    for backward in (True, False):
        assert 20 <= topk.past_cut_off(df, 20, backward, Window(0, 3_000_009_000)).count() <= 25


def test_tasks_cut_before_rows_move(spark):
    """All rows share an instant: no more than n rows leave a task."""
    df = table(spark, TIMES["one instant"])
    cut = topk._cut(df, 30, [F.col("line")])
    assert cut.count() == 30 * df.rdd.getNumPartitions()
    plan = formatted_plan(newest(df, 5000))
    assert "WindowGroupLimit" not in plan and plan.count("RowNumber") == 0


def test_cut_off_prunes_days_at_run_time(spark, tmp_path):
    day = 86_400 * 10**9
    df = spark.range(2000).select(
        (F.col("id") * (day // 100)).alias("ts_ns"),
        F.expr("timestamp_ntz'1970-01-01'").alias("timestamp"),
        F.lit("l").alias("line"),
        F.expr("map('job', 'api')").alias("labels"),
        F.expr("cast(map() as map<string,string>)").alias("structured_metadata"),
    )
    write_logs(df, str(tmp_path / "t"))
    logs = read_logs(spark, str(tmp_path / "t"))
    result = newest(logs, 30, window=Window(0, 20 * day))
    assert sorted(r.ts_ns for r in result.collect()) == [i * (day // 100) for i in range(1970, 2000)]
    plan = formatted_plan(result)
    filters = [line for line in plan.splitlines() if line.startswith("PartitionFilters")]
    assert any("day" in line and "ubquery" in line for line in filters)
