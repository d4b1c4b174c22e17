from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logframe import log_table, merge_pages, merge_pages_limited


@pytest.fixture(scope="module")
def pages(spark):
    def build(*entries_per_page):
        rows = []
        for page, entries in enumerate(entries_per_page):
            for ts, line, *rest in entries:
                labels = rest[0] if rest else {"job": "x"}
                rows.append((page, ts, line, labels, rest[1] if len(rest) > 1 else {}))
        df = spark.createDataFrame(
            rows, "page_id int, ts bigint, l string, ls map<string,string>, m map<string,string>"
        )
        return log_table(df, ts_ns=F.col("ts"), line=F.col("l"), labels=F.col("ls"), metadata=F.col("m"), keep=["page_id"])

    return build


def model(entries_per_page, limit, direction):
    """Each entry as often as on the page that has most of it, in order."""
    most = Counter()
    for page in entries_per_page:
        most |= Counter(page)
    return sorted(most.elements(), reverse=direction == "backward")[:limit]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_served_pages_equal_the_model(pages, seed, direction):
    """Pages as a server gives them: each begins again at the instant at which the last one stopped."""
    rng = random.Random(seed)
    entries = sorted(((rng.randrange(1, 15) * 7, rng.choice(["up", "down", "idle"])) for _ in range(rng.randrange(5, 40))), reverse=direction == "backward")
    size, served, at = rng.randrange(3, 9), [], 0
    while at < len(entries):
        served.append(entries[at : at + size])
        last = entries[min(at + size, len(entries)) - 1][0]
        again = next(i for i, e in enumerate(entries) if e[0] == last)
        at = again if again > at else at + size
    for limit in (1, 4, 1000):
        merged = merge_pages_limited(pages(*served), limit, direction)
        assert [(r.ts_ns, r.line) for r in merged.collect()] == model(served, limit, direction)


def test_limit_counts_merged_rows(pages):
    rng = random.Random(5)
    entries = [[(rng.randrange(50), rng.choice("ab")) for _ in range(60)] for _ in range(4)]
    entries.append([(49, "hot")] * 40)
    entries.append([(49, "hot")] * 41)
    for direction in ("backward", "forward"):
        for limit in (1, 30, 45, 100, 1000):
            merged = merge_pages_limited(pages(*entries), limit, direction)
            assert [(r.ts_ns, r.line) for r in merged.collect()] == model(entries, limit, direction)


def test_metadata_survives_and_is_not_part_of_the_key(pages):
    job = {"job": "x"}
    merged = merge_pages(pages([(1, "a", job, {"t": "1"})], [(1, "a", job, {"t": "1"}), (2, "b", job, {"t": "2"})]))
    assert sorted((r.line, r.structured_metadata["t"]) for r in merged.collect()) == [("a", "1"), ("b", "2")]
    assert "page_id" not in merged.columns
    twice = merge_pages(pages([(1, "a", job, {"t": "1"})], [(1, "a", job, {"t": "other"})]))
    assert twice.count() == 1


def test_copies_within_one_page_are_kept(pages):
    job = {"job": "x"}
    first = [(5, "a", job, {"n": "1"}), (5, "a", job, {"n": "2"}), (4, "b")]
    assert merge_pages(pages(first)).count() == 3
    merged = merge_pages(pages(first, [(5, "a", job, {"n": "1"})]))
    assert sorted(r.line for r in merged.collect()) == ["a", "a", "b"]
    assert sorted(r.structured_metadata.get("n", "") for r in merged.collect()) == ["", "1", "2"]


def test_labels_are_part_of_the_key(pages):
    merged = merge_pages(pages([(1, "a", {"job": "x"})], [(1, "a", {"job": "y"}), (1, "a", {})]))
    assert merged.count() == 3


def test_random_pages_equal_brute_force(pages):
    rng = random.Random(11)
    entries = []
    for _ in range(6):
        page = [(rng.randrange(6), rng.choice("ab"), {"job": rng.choice("xy")}) for _ in range(rng.randrange(40))]
        # A hot entry: a third of everything, on every page.
        page += [(3, "hot", {"job": "x"})] * rng.randrange(30)
        entries.append(page)
    expected = Counter()
    for page in entries:
        expected |= Counter((ts, line, labels["job"]) for ts, line, labels in page)
    merged = merge_pages(pages(*entries)).collect()
    assert Counter((r.ts_ns, r.line, r.labels["job"]) for r in merged) == expected


def test_merge_without_broadcast(spark, pages):
    """The plan of inputs too large to broadcast gives the same rows."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        served = [[(31, "z"), (20, "y"), (20, "y")], [(20, "y"), (11, "x")], [(11, "x")]]
        merged = merge_pages(pages(*served))
        assert sorted(r.line for r in merged.collect()) == ["x", "y", "y", "z"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_any_page_name_and_type(pages):
    named = pages([(3, "z"), (2, "y")], [(2, "y"), (1, "x")]).withColumn("part", F.concat(F.lit("p"), F.col("page_id").cast("string"))).drop("page_id")
    assert merge_pages(named, page="part").count() == 3


def test_null_parts_are_kept_apart(spark):
    """A NULL line, NULL labels and a NULL time are values of their own."""
    rows = [(1, 5, None, {"job": "x"}), (1, 5, None, {"job": "y"}), (1, 5, "", {"job": "x"}), (1, 5, "a", None), (1, None, "a", {"job": "x"})]
    again = [(2, *r[1:]) for r in rows] + [(2, None, "b", {"job": "x"})]
    df = spark.createDataFrame(rows + again, "page_id int, ts_ns long, line string, labels map<string,string>")
    assert merge_pages(df).count() == 6
