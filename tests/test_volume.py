from __future__ import annotations

import random
from collections import Counter
from datetime import timedelta

import pytest

from logframe import bytes_over_time, bytes_rate, count_over_time, rate
from logframe.plans import formatted_plan
from tests.conftest import BASE_NS, SECOND

JOBS = [("job", "=~", ".+")]


def entries(seed, n, span):
    drawn = random.Random(seed)
    return [
        (BASE_NS + drawn.choice([drawn.randrange(-span, span), drawn.randrange(-9, 9) * 10 * SECOND]), "x" * drawn.randrange(9), {"job": drawn.choice("ab"), **({"pod": "p"} if drawn.random() < 0.3 else {})})
        for _ in range(n)
    ]


def brute(rows, step, reach, first, last, fill, key, weigh):
    """Every window counted by itself."""
    steps = range(first, last + 1, step)
    found = {}
    for labels in {key(r) for r in rows if any(t - reach < r[0] <= t for t in steps)}:
        for t in steps:
            value = sum(weigh(r) for r in rows if key(r) == labels and t - reach < r[0] <= t)
            if fill or value:
                found[t, labels] = value
    return found


@pytest.mark.parametrize("step, reach", [(10, 10), (10, 35), (7, 20), (30, 4), (10, 300), (60, 61)])
@pytest.mark.parametrize("fill", [True, False])
def test_counts_against_every_window(logs, step, reach, fill):
    rows = entries(step * reach, 150, 100 * SECOND)
    first, last = BASE_NS - 50 * SECOND, BASE_NS + 47 * SECOND
    arguments = {"step": timedelta(seconds=step), "range": timedelta(seconds=reach), "start": first, "end": last, "fill": fill}
    got = count_over_time(logs(rows), JOBS, by=["job", "pod"], **arguments)
    assert got.columns == ["timestamp", "ts_ns", "job", "pod", "value"]
    want = brute(rows, step * SECOND, reach * SECOND, first, last, fill, lambda r: (r[2]["job"], r[2].get("pod")), lambda r: 1)
    assert {(r.ts_ns, (r.job, r.pod)): r.value for r in got.collect()} == want
    size = bytes_over_time(logs(rows), '{job="a"} != "xxxxxxxx"', **arguments)
    assert size.columns == ["timestamp", "ts_ns", "labels", "labels_key", "value"]
    chosen = [r for r in rows if r[2]["job"] == "a" and len(r[1]) < 8]
    want = brute(chosen, step * SECOND, reach * SECOND, first, last, True, lambda r: tuple(sorted(r[2].items())), lambda r: len(r[1]))
    got = {(r.ts_ns, tuple(sorted(r.labels.items()))): r.value for r in size.collect()}
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
    assert not fill or got == want


def test_rates_are_values_over_the_range(logs):
    table = logs([(BASE_NS, "four", {"job": "a"}), (BASE_NS + 1, "", {"job": "a"})])
    arguments = {"step": SECOND, "range": 4 * SECOND, "start": BASE_NS, "end": BASE_NS + 5 * SECOND}
    assert [r.value for r in rate(table, JOBS, **arguments).orderBy("ts_ns").collect()] == [0.25, 0.5, 0.5, 0.5, 0.25, 0.0]
    assert [r.value for r in bytes_rate(table, JOBS, **arguments).orderBy("ts_ns").collect()] == [1.0, 1.0, 1.0, 1.0, 0.0, 0.0]


def test_default_hour_and_empty_selection(logs):
    table = logs([(BASE_NS - 30 * 60 * SECOND, "x", {"job": "a"})])
    got = count_over_time(table, JOBS, step=timedelta(minutes=20), now=BASE_NS)
    assert Counter(r.value for r in got.collect()) == {0: 3, 1: 1}
    assert count_over_time(table, [("job", "=", "none")], step=timedelta(minutes=20), now=BASE_NS).count() == 0


def test_bad_arguments(logs):
    table = logs([(BASE_NS, "x", {"job": "a"})])
    for arguments in ({"step": 0}, {"step": 1.5}, {"step": SECOND, "range": -1}, {"step": True}, {"step": 1}, {"step": SECOND, "start": 10, "end": 5}, {"step": SECOND, "by": ["line"]}):
        with pytest.raises(ValueError):
            count_over_time(table, JOBS, now=BASE_NS, **arguments)
    with pytest.raises(ValueError):
        count_over_time(table, [("job", "!=", "a")], step=SECOND, now=BASE_NS)


def test_only_counts_are_shuffled(logs):
    """Entries are combined before the first exchange, and nothing multiplies them before."""
    plan = formatted_plan(count_over_time(logs(entries(1, 20, SECOND), promote=["job"]), JOBS, step=SECOND, range=100 * SECOND, by=["job"], start=BASE_NS, end=BASE_NS + 50 * SECOND))
    tree = plan.split("\n\n")[0].splitlines()  # from the result down to the scan
    depth = {name: [i for i, line in enumerate(tree) if name in line] for name in ("Generate", "Exchange", "HashAggregate")}
    deepest = max(depth["Exchange"])
    assert max(depth["HashAggregate"]) > deepest  # the partial one below
    assert all(i < deepest for i in depth["Generate"])
    assert "line" not in plan.split("Exchange")[-1].split("\n")[0]
