from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from logframe import parse_series, parse_streams, parse_string_array, payload_rejects, read_payloads
from logframe.sources.payload import SERIES, STRING_ARRAY
from workload.payloads import entry_payloads


@pytest.fixture(scope="module")
def bodies(spark):
    def build(*texts):
        texts = [t if isinstance(t, str) or t is None else json.dumps(t) for t in texts]
        return spark.createDataFrame(list(enumerate(texts)), "id int, body string")

    return build


def streams(*result, kind="streams"):
    return {"status": "success", "data": {"resultType": kind, "result": list(result)}}


SAMPLE = streams(
    {
        "stream": {"unit": "pump", "site": "north"},
        "values": [
            ["1699999999123456789", "pressure 3.1 bar"],
            ["1699999999123456790", "pressure 3.4 bar", {"structuredMetadata": {"shift": "late"}, "parsed": {"bar": "3.4"}}],
        ],
    },
    {
        "stream": {"unit": "valve"},
        "values": [["1699999999123456791", "shut", {"structuredMetadata": {"by": "k", "shift": "late"}}]],
    },
)


def test_streams(bodies):
    parsed = parse_streams(bodies(SAMPLE))
    assert parsed.columns == ["ts_ns", "timestamp", "line", "labels", "structured_metadata"]
    rows = sorted(parsed.collect())
    assert [(r.ts_ns, r.line, r.labels, r.structured_metadata) for r in rows] == [
        (1699999999123456789, "pressure 3.1 bar", {"unit": "pump", "site": "north"}, {}),
        (1699999999123456790, "pressure 3.4 bar", {"unit": "pump", "site": "north"}, {"shift": "late"}),
        (1699999999123456791, "shut", {"unit": "valve"}, {"by": "k", "shift": "late"}),
    ]


def test_repeated_names_keep_the_entry_and_the_first_value(bodies):
    values = (
        '["1","x",{"parsed":{"n":"1","n":"2"},"structuredMetadata":{"a":5,"a":"1","a":"2"}}],["2","y"],'
        '["3","with \\"quotes\\", [brackets]",{"structuredMetadata":{"s":"first"},"structuredMetadata":{"s":"last"}}],[4,"z",{"a":1,"a":2}],["5",6,{"a":1,"a":2}]'
    )
    body = '{"data":{"resultType":"streams","result":[{"stream":{"job":1,"job":"a","job":"b"},"values":[' + values + "]}]}}"
    rows = sorted(parse_streams(bodies(body)).collect())
    assert [(r.ts_ns, r.line, r.structured_metadata) for r in rows] == [
        (1, "x", {"a": "1"}),
        (2, "y", {}),
        (3, 'with "quotes", [brackets]', {"s": "first"}),
        (5, "", {}),
    ]
    assert {r.labels["job"] for r in rows} == {"a"}
    series_ = parse_series(bodies('{"data":[{"a":"1","a":"2"},null,5,{}]}')).collect()
    assert [r.labels for r in series_] == [{"a": "1"}, {}, {}, {}]


def entries(bodies, *values, stream={"a": "b"}):
    rows = parse_streams(bodies(streams({"stream": stream, "values": list(values)}))).collect()
    return [(r.ts_ns, r.line, r.structured_metadata) for r in sorted(rows)]


def test_odd_entries_do_not_spoil_their_neighbours(bodies):
    found = entries(
        bodies,
        ["1", "two elements"],
        ["2"],
        ["3", 5],
        ["4", None],
        [5, "numeric time"],
        ["x", "bad time"],
        ["", "no time"],
        ["99999999999999999999", "too large"],
        ["6abc", "text after the number"],
        [" -7", "signed"],
        "not a list",
        {"not": "a list"},
        None,
        [],
        ["8", "text\nwith \"quotes\" and é", {"structuredMetadata": {"n": 1, "s": "v", "o": {"a": "b"}}}],
        ["9", "odd metadata", {"structuredMetadata": "text"}],
        ["10", "odd extra", 5],
    )
    assert found == [
        (-7, "signed", {}),
        (1, "two elements", {}),
        (2, "", {}),
        (3, "", {}),
        (4, "", {}),
        (6, "text after the number", {}),
        (8, "text\nwith \"quotes\" and é", {"s": "v"}),
        (9, "odd metadata", {}),
        (10, "odd extra", {}),
    ]


def test_odd_streams_do_not_spoil_their_neighbours(bodies):
    payload = streams(
        5,
        {"values": [["1", "no labels"]]},
        {"stream": {"a": "b"}},
        {"stream": {"a": "b", "n": 1, "l": ["x"]}, "values": [["2", "labels of other types"]]},
        {"stream": "text", "values": [["3", "labels are text"]]},
        {"stream": {"a": "b"}, "values": "text"},
        None,
    )
    rows = sorted(parse_streams(bodies(payload)).collect())
    assert [(r.ts_ns, r.labels) for r in rows] == [(1, {}), (2, {"a": "b"}), (3, {})]


@pytest.mark.parametrize("payload", [streams(), {"data": {"resultType": "streams"}}, {"data": {"resultType": "streams", "result": {}}}])
def test_empty_results(bodies, payload):
    assert parse_streams(bodies(payload)).collect() == []
    assert payload_rejects(bodies(payload)).collect() == []


BAD = [
    ("not json", "not valid JSON"),
    ("", "not valid JSON"),
    (json.dumps(SAMPLE)[:-3], "not valid JSON"),
    (json.dumps(SAMPLE) + " trailing", "not valid JSON"),
    (json.dumps(SAMPLE) + "," + json.dumps(SAMPLE), "not valid JSON"),
    ("{'data': 5}", "not valid JSON"),
    ('{"status":"error"}', "missing data"),
    ("[1,2]", "missing data"),
    ('"text"', "missing data"),
    (json.dumps(streams(kind="matrix")), "resultType is matrix"),
    ('{"data":{}}', "resultType is (none)"),
    ('{"data":{"resultType":5}}', "resultType is (none)"),
    ('{"data":["a"]}', "resultType is (none)"),
]


def test_rejects(bodies):
    found = payload_rejects(bodies(*(body for body, _ in BAD), SAMPLE)).orderBy("id").collect()
    assert [(r.id, r.reason) for r in found] == [(i, reason) for i, (_, reason) in enumerate(BAD)]
    assert [r.snippet for r in found] == [b if len(b) <= 500 else b[:500] + "..." for b, _ in BAD]


@pytest.mark.parametrize(("body", "reason"), BAD[:1] + BAD[6:7] + BAD[9:10])
def test_invalid_payloads_fail_or_are_skipped(bodies, body, reason):
    with pytest.raises(Exception) as error:
        parse_streams(bodies(body, SAMPLE)).collect()
    assert reason in str(error.value)
    assert parse_streams(bodies(body, SAMPLE), on_invalid="skip").count() == 3
    with pytest.raises(ValueError):
        parse_streams(bodies(body), on_invalid="ignore")


def test_null_body(bodies):
    assert parse_streams(bodies(None, SAMPLE), on_invalid="skip").count() == 3
    assert [r.reason for r in payload_rejects(bodies(None, SAMPLE)).collect()] == ["not valid JSON"]


def test_long_snippet(bodies):
    snippet = payload_rejects(bodies("x" * 1000)).first().snippet
    assert snippet == "x" * 500 + "..."


def test_string_array(bodies):
    parsed = parse_string_array(bodies({"data": ["job", "level", 5, None, True, ["x"], {"a": "b"}, "pod", "5"]}, {"data": []}))
    assert [r.value for r in parsed.collect()] == ["job", "level", "pod", "5"]
    for body in ({"status": "ok"}, {"data": "text"}, {"data": {"a": "b"}}, {"data": None}):
        with pytest.raises(Exception, match="missing data"):
            parse_string_array(bodies(body)).collect()
        assert payload_rejects(bodies(body), kind=STRING_ARRAY).first().reason == "missing data"
    with pytest.raises(Exception, match="not valid JSON"):
        parse_string_array(bodies("nope")).collect()


def test_series(bodies):
    payload = {"data": [{"job": "api", "level": "error"}, {"job": "api", "n": 1}, {"job": "web"}, {}]}
    assert [r.labels for r in parse_series(bodies(payload)).collect()] == [
        {"job": "api", "level": "error"},
        {"job": "api"},
        {"job": "web"},
        {},
    ]
    assert parse_series(bodies({"data": []})).collect() == []
    with pytest.raises(Exception, match="missing data"):
        parse_series(bodies({"data": 5})).collect()
    assert payload_rejects(bodies({"data": 5}), kind=SERIES).first().reason == "missing data"
    with pytest.raises(ValueError):
        payload_rejects(bodies({}), kind="other")


def test_round_trip(logs):
    rows = [(i, f'line "{i}"\n\\ é', {"job": str(i % 3), "q": '"'}, {"n": str(i)} if i % 2 else {}) for i in range(200)]
    table = logs(rows)
    back = parse_streams(entry_payloads(table))
    assert sorted(map(str, back.select(table.columns).collect())) == sorted(map(str, table.collect()))


def test_payload_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(SAMPLE, indent=2))
    (tmp_path / "b.json").write_text("oops")
    files = read_payloads(spark, str(tmp_path))
    assert parse_streams(files, on_invalid="skip").count() == 3
    reject = payload_rejects(files).first()
    assert reject.path.endswith("b.json") and reject.reason == "not valid JSON" and reject.snippet == "oops"


def test_kept_columns(bodies):
    kept = parse_streams(bodies(SAMPLE).withColumn("tenant", F.lit("t1")), keep=("tenant",))
    assert kept.columns[0] == "tenant" and {r.tenant for r in kept.collect()} == {"t1"}
