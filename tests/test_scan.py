from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from logframe import label_column, label_values, refine_logs, scan_logs
from logframe.functions.lines import line_filter_column
from logframe.functions.matchers import matcher_column, selects_something
from logframe.functions.selector_text import read_selector
from tests.conftest import BASE_NS, SECOND

API = [("job", "=", "api")]
SHOP = [("job", "=", "shop")]
ANY = [("job", "=~", ".+")]


def lines(df):
    return sorted(r.line for r in df.collect())


# Schema and projection ------------------------------------------------------


def test_schema_order_and_types(seeded, base_window):
    scan = scan_logs(seeded, API, labels=["level", "pod"], **base_window)
    assert [(f.name, f.dataType.simpleString()) for f in scan.schema] == [
        ("timestamp", "timestamp_ntz"),
        ("ts_ns", "bigint"),
        ("line", "string"),
        ("level", "string"),
        ("pod", "string"),
        ("labels", "map<string,string>"),
        ("structured_metadata", "map<string,string>"),
    ]
    assert scan_logs(seeded, API, **base_window).columns == ["timestamp", "ts_ns", "line", "labels", "structured_metadata"]


def test_promotion_is_sparse_and_metadata_never_null(logs):
    table = logs(
        [
            (BASE_NS + 4, "disk 81 %", {"job": "api", "host": "h9"}, {"rack": "r2", "slot": "7"}),
            (BASE_NS + 5, None, {"job": "api"}, {}),
            (BASE_NS + 7, "disk 82 %", {"job": "api", "host": "h3", "level": "warn"}, {"slot": "1"}),
        ]
    )
    scan = scan_logs(table, API, labels=["host"], start=BASE_NS, end=BASE_NS + 10)
    rows = scan.orderBy("ts_ns").select(
        "ts_ns", "line", "host", F.size("structured_metadata").alias("n"), F.col("structured_metadata")["slot"].alias("slot")
    )
    assert [tuple(r) for r in rows.collect()] == [
        (BASE_NS + 4, "disk 81 %", "h9", 2, "7"),
        (BASE_NS + 5, "", None, 0, None),
        (BASE_NS + 7, "disk 82 %", "h3", 1, "1"),
    ]


def test_table_without_metadata_column(seeded, base_window):
    scan = scan_logs(seeded.drop("structured_metadata"), SHOP, **base_window)
    assert {r.n for r in scan.select(F.size("structured_metadata").alias("n")).collect()} == {0}


def test_other_text_columns_do_not_stand_for_a_label(logs):
    table = logs([(BASE_NS, "x", {"job": "api", "source": "A"})]).withColumn("source", F.lit("B"))
    scan = scan_logs(table, [("source", "=", "A")], start=BASE_NS, end=BASE_NS + 1, keep=["source"])
    assert [(r.source, r.labels["source"]) for r in scan.collect()] == [("B", "A")]
    assert [r.value for r in label_values(table, "source").collect()] == ["A"]


def test_promoted_column_is_preferred_over_the_map(logs):
    table = logs([(BASE_NS, "x", {"job": "api"})], promote=["job"])
    assert "labels" not in str(label_column(table, "job"))
    assert "labels" in str(label_column(table, "level"))


# The seeded selections --------------------------------------------------------


def test_selections(seeded, base_window):
    assert scan_logs(seeded, SHOP, **base_window).count() == 5
    fatal = {"labels": ["level"], "label_where": [("level", "=", "fatal")], **base_window}
    assert lines(refine_logs(seeded, SHOP, **fatal)) == ["ledger locked", "payment refused by bank"]
    bank = [("contains", "bank")]
    assert lines(scan_logs(seeded, SHOP, line=bank, **base_window)) == ["payment refused by bank"]
    assert lines(scan_logs(seeded, ANY, line=bank, **base_window)) == ["letter bounced: bank", "payment refused by bank"]
    window = {"start": BASE_NS + 2 * SECOND, "end": BASE_NS + 7 * SECOND}
    assert lines(scan_logs(seeded, SHOP, **window)) == ["ledger locked", "payment refused by bank"]
    plain = scan_logs(seeded, [*SHOP, ("level", "=", "fatal")], line=bank, **base_window).select("ts_ns", "line")
    refined = refine_logs(seeded, SHOP, line=bank, **fatal).select("ts_ns", "line")
    assert plain.count() == 1 and plain.exceptAll(refined).count() == refined.exceptAll(plain).count() == 0


def test_selector_text(seeded, base_window):
    text = '{job=~"shop|mail", level!="info"} |= "a" != "cart" |~ `(?i)BANK$` !~ "^letter\\x20"'
    assert lines(scan_logs(seeded, text, **base_window)) == ["payment refused by bank"]
    assert lines(refine_logs(seeded, '{job="shop"}', line=[("contains", "led")], **base_window)) == ["ledger locked"]


@pytest.mark.parametrize(
    ("text", "matchers", "filters"),
    [
        ('{a="b"}', [("a", "=", "b")], []),
        (' { a = "b" , c!~`d"\\` } ', [("a", "=", "b"), ("c", "!~", 'd"\\')], []),
        ('{a="\\"\\\\\\n\\u00e9"}|="x"|~"y"!="z"!~`w`', [("a", "=", '"\\\né')], [("contains", "x"), ("regex", "y"), ("not contains", "z"), ("not regex", "w")]),
        ("{}", [], []),
    ],
)
def test_selector_text_is_read(text, matchers, filters):
    assert read_selector(text) == (matchers, filters)


@pytest.mark.parametrize(
    "text",
    ["", "job", '{job="a"', '{job="a",}', '{job=a}', '{job=="a"}', '{="a"}', '{job="a"} | json', '{job="a"} |= x', 'rate({job="a"}[5m])',
     '{job="a"}[5m]', '{job="a"} or {job="b"}', '{job="\\q"}', '{job="a" c="d"}', "{}", '{job!="a"}', '{job=~"(?=x)"}'],
)
def test_other_text_is_refused_before_any_job(seeded, text):
    with pytest.raises(ValueError):
        scan_logs(seeded, text)


def test_empty_selection(seeded, base_window):
    assert scan_logs(seeded, [("job", "=", "nothing")], **base_window).collect() == []


# Matchers ---------------------------------------------------------------------

LABEL_SETS = [{}, {"a": ""}, {"a": "x"}, {"a": "xy"}, {"a": "x\n"}, {"a": "y|x"}, {"a": "é"}, {"b": "x"}]


def as_selector(op, value, actual):
    """What a matcher means, stated in Python: a missing label is the empty string."""
    import re

    text = actual or ""
    if op in ("=", "!="):
        return (text == value) == (op == "=")
    return (re.fullmatch(value, text) is not None) == (op == "=~")


@pytest.mark.parametrize("promote", [(), ("a",)])
def test_every_matcher_on_every_label_set(logs, promote):
    table = logs([(i, "l", labels) for i, labels in enumerate(LABEL_SETS)], promote=promote)
    cases = [(op, v) for op in ("=", "!=") for v in ("", "x", "xy", "nope")]
    cases += [(op, v) for op in ("=~", "!~") for v in ("x", "x.*", "", "x|", "x|xy", ".+", ".*", "(x|y).*", "[^y]", "nope")]
    columns = [matcher_column(table, ("a", op, v)).alias(f"c{i}") for i, (op, v) in enumerate(cases)]
    rows = {r.ts_ns: r for r in table.select("ts_ns", *columns).collect()}
    for i, (op, value) in enumerate(cases):
        for n, labels in enumerate(LABEL_SETS):
            expected = as_selector(op, value, labels.get("a"))
            found = rows[n][f"c{i}"]
            # A filter treats NULL as false; only '=' with a value and '!=' '' may say so.
            assert bool(found) == expected, (op, value, labels)


def test_label_predicates_follow_sql(logs):
    table = logs([(i + 1, str(i), {"k": "v", **labels}) for i, labels in enumerate(LABEL_SETS)])
    base = {"selector": [("k", "=", "v")], "labels": ["a"], "start": 0, "end": 100}
    assert lines(refine_logs(table, label_where=[("a", "!=", "x")], **base)) == ["1", "3", "4", "5", "6"]
    assert lines(refine_logs(table, label_where=[("a", "=", "")], **base)) == ["1"]
    assert lines(refine_logs(table, label_where=[("a", "in", ["", "x", "y|x"])], **base)) == ["1", "2", "5"]


def test_not_equal_drops_missing_labels_after_the_limit(logs):
    table = logs([(1, "old", {"k": "v", "a": "y"}), (2, "missing", {"k": "v"}), (3, "equal", {"k": "v", "a": "x"})])
    scan = refine_logs(
        table, [("k", "=", "v")], labels=["a"], label_where=[("a", "!=", "x")], start=0, end=10, limit=1
    )
    assert lines(scan) == []


def test_predicates_can_stand_in_for_the_selector(seeded, base_window):
    by_eq = refine_logs(seeded, labels=["job"], label_where=[("job", "=", "mail")], **base_window)
    by_in = refine_logs(seeded, labels=["job"], label_where=[("job", "in", ["mail"])], **base_window)
    assert by_eq.count() == by_in.count() == 3


# Line filters -------------------------------------------------------------------


def test_line_filters(logs):
    texts = ["", "abc", "xabc", "abcx", "a.c", "ABC", "abc\n", "a\rc", "x\nabc"]
    table = logs([(i, text, {}) for i, text in enumerate(texts)])
    meaning = {
        "contains": lambda line, v: v in line,
        "prefix": lambda line, v: line.startswith(v),
        "suffix": lambda line, v: line.endswith(v),
    }
    for op, test in meaning.items():
        for value in ("abc", "a.c", "", "c"):
            expected = sorted(t for t in texts if test(t, value))
            rejected = sorted(t for t in texts if not test(t, value))
            assert lines(table.where(line_filter_column((op, value)))) == expected
            assert lines(table.where(line_filter_column((f"not {op}", value)))) == rejected
    assert lines(table.where(line_filter_column(("regex", "^a.c$")))) == ["a\rc", "a.c", "abc"]
    assert len(lines(table.where(line_filter_column(("not regex", "^a.c$"))))) == len(texts) - 3


# Limit and direction ------------------------------------------------------------


def test_limit_direction_and_residual(seeded, base_window):
    newest = scan_logs(seeded, ANY, limit=2, **base_window)
    assert [r.line for r in newest.collect()] == ["cart closed", "letter bounced: bank"]
    oldest = scan_logs(seeded, ANY, limit=3, direction="FORWARD", **base_window)
    assert [r.line for r in oldest.collect()] == ["cart opened", "cart slow: 900 ms", "payment refused by bank"]
    residual = scan_logs(seeded, ANY, limit=2, labels=["job"], **base_window).where(F.col("job") == "mail")
    assert lines(residual) == ["letter bounced: bank"]


def test_default_limit_is_5000(logs, spark):
    table = spark.range(6000).select(
        F.col("id").alias("ts_ns"),
        F.expr("timestamp_ntz'1970-01-01'").alias("timestamp"),
        F.lit("l").alias("line"),
        F.expr("map('job', 'api')").alias("labels"),
    )
    assert scan_logs(table, API, start=0, end=6000).agg(F.min("ts_ns"), F.count("*")).first() == (1000, 5000)
    assert scan_logs(table, API, start=0, end=6000, limit=None).count() == 6000


def test_default_window_is_the_last_hour(logs):
    hour = 3_600 * SECOND
    table = logs([(BASE_NS - hour - 1, "before", {"job": "api"}), (BASE_NS - hour, "in", {"job": "api"}), (BASE_NS, "after", {"job": "api"})])
    assert lines(scan_logs(table, API, now=BASE_NS)) == ["in"]
    # A WHERE bound replaces the default start.
    assert lines(refine_logs(table, API, time_where=[(">=", 0)], now=BASE_NS)) == ["before", "in"]
    assert lines(refine_logs(table, API, time_where=[("<=", BASE_NS)], now=BASE_NS)) == ["after", "in"]
    assert lines(refine_logs(table, API, time_where=[("=", BASE_NS)], now=BASE_NS)) == ["after"]
    # Explicit bounds intersect with it.
    assert lines(refine_logs(table, API, start=BASE_NS - hour, time_where=[(">=", 0)], now=BASE_NS)) == ["in"]


# Validation ---------------------------------------------------------------------


@pytest.mark.parametrize(
    "selector",
    [None, [], [("job", "!=", "api")], [("job", "=", "")], [("job", "=~", ".*")], [("job", "=~", "a|")], [("job", "!~", "a")]],
)
def test_a_selector_is_required(seeded, selector):
    with pytest.raises(ValueError, match="selector"):
        scan_logs(seeded, selector)
    if selector is not None:
        with pytest.raises(ValueError, match="selector"):
            refine_logs(seeded, selector, labels=["level"], label_where=[("level", "!=", "x")])
        assert not selects_something(selector)


@pytest.mark.parametrize(
    "arguments",
    [
        {"limit": 0},
        {"limit": -1},
        {"limit": True},
        {"limit": 1.5},
        {"direction": "sideways"},
        {"labels": [None]},
        {"labels": ["line"]},
        {"labels": ["Timestamp"]},
        {"labels": ["labels"]},
        {"labels": ["a", "A"]},
        {"labels": "job"},
        {"start": {"months": 1}},
        {"line": [("like", "%a_b%")]},
        {"line": [("contains", 5)]},
        {"line": [("regex", "a(?=b)")]},
        {"selector": [("job", "~", "x")]},
        {"selector": [("", "=", "x")]},
        {"selector": [("job", "=", 5)]},
    ],
)
def test_arguments_are_checked_before_any_job(seeded, arguments):
    with pytest.raises(ValueError):
        scan_logs(seeded, **{"selector": API, **arguments})


@pytest.mark.parametrize(
    "predicate", [("level", "<", "x"), ("pod", "=", "x"), ("level", "in", []), ("level", "in", [None]), ("level", "=", None)]
)
def test_label_predicates_are_checked(seeded, predicate):
    with pytest.raises(ValueError):
        refine_logs(seeded, API, labels=["level"], label_where=[predicate])


def test_building_a_scan_runs_no_job(spark, seeded):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    try:
        scan_logs(seeded, API, labels=["level"], limit=10).schema
        assert list(tracker.getJobIdsForGroup("lazy")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# Agreement of built scans with plain SQL ------------------------------------------


def test_random_selections_agree_with_sql(spark, logs):
    rng = random.Random(7)
    values = [None, "", "a", "ab", "b"]
    words = ["", "ab", "a b", "b", "abab", "%_", "a\nb"]
    rows = []
    for i in range(300):
        labels = {k: v for k in ("x", "y") if (v := rng.choice(values)) is not None}
        rows.append((i, rng.choice(words), {"k": "v", **labels}))
    table = logs(rows, promote=["y"]).cache()
    table.createOrReplaceTempView("agreement")
    sql_matcher = {
        "=": "coalesce(labels['{0}'], '') = '{1}'",
        "!=": "coalesce(labels['{0}'], '') <> '{1}'",
        "=~": "coalesce(labels['{0}'], '') RLIKE '^(?:{1})$'",
        "!~": "NOT coalesce(labels['{0}'], '') RLIKE '^(?:{1})$'",
    }
    sql_line = {"contains": "contains(line, '{0}')", "prefix": "startswith(line, '{0}')", "suffix": "endswith(line, '{0}')"}
    compared = 0
    for _ in range(25):
        selector, where = [("k", "=", "v")], ["true"]
        for _ in range(rng.randint(0, 2)):
            name, op = rng.choice("xy"), rng.choice(list(sql_matcher))
            value = rng.choice(["", "a", "ab"] if op in ("=", "!=") else ["a", "a.*", "a|b", "b?", "[ab]+"])
            selector.append((name, op, value))
            where.append(sql_matcher[op].format(name, value))
        filters = []
        for _ in range(rng.randint(0, 2)):
            op, value, negated = rng.choice(list(sql_line)), rng.choice(["a", "b", "ab", " "]), rng.random() < 0.4
            filters.append((("not " if negated else "") + op, value))
            where.append(("NOT " if negated else "") + sql_line[op].format(value))
        start, end = sorted((rng.randrange(300), rng.randrange(300)))
        where.append(f"ts_ns >= {start} AND ts_ns < {end}")
        built = sorted(r.ts_ns for r in scan_logs(table, selector, line=filters, start=start, end=end, limit=None).collect())
        plain = sorted(r.ts_ns for r in spark.sql(f"SELECT ts_ns FROM agreement WHERE {' AND '.join(where)}").collect())
        assert built == plain, (selector, filters, start, end)
        compared += len(built)
    assert compared > 0
