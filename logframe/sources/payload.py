"""Captured JSON payloads as DataFrames.

A payload is one JSON document per row of a string column: a stream result
(``data.result[]`` of label sets and ``[time, line, {..}]`` entries), a list of
strings, or a list of label sets.

The document is opened one level at a time: each level is parsed only down to the
raw text of its elements and exploded, so one odd element never spoils its
neighbours and no row carries more than it needs.  JSON types are respected: where a
string is expected, numbers and other values are skipped rather than converted.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logframe.functions.timebounds import timestamp_of
from logframe.model import LABELS, LINE, METADATA, TIMESTAMP, TS_NS, empty_map

SNIPPET_CHARACTERS = 500

STREAMS = "streams"
STRING_ARRAY = "string_array"
SERIES = "series"
KINDS = (STREAMS, STRING_ARRAY, SERIES)

_JSON_OPTIONS = {"allowSingleQuotes": "false"}


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per captured file: ``path`` and ``body``."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def _parse(text: Column, schema: str) -> Column:
    return F.from_json(text, schema, _JSON_OPTIONS)


def _documents(body: Column, schema: str) -> Column:
    """The JSON documents of a body; NULL when it is not JSON of that schema.

    The brackets make text after the document an error, which a bare parse would ignore.
    """
    return _parse(F.concat(F.lit("["), body, F.lit("]")), f"array<{schema}>")


def _only_data(documents: Column) -> Column:
    """``data`` of the document, if there is exactly one."""
    return F.when(F.size(documents) == 1, F.get(documents, F.lit(0))["data"])


def _snippet(body: Column) -> Column:
    text = F.coalesce(body, F.lit(""))
    cut = F.concat(F.substring(text, 1, SNIPPET_CHARACTERS), F.lit("..."))
    return F.when(F.length(text) > SNIPPET_CHARACTERS, cut).otherwise(text)


def _is_string(variant: Column) -> Column:
    return F.coalesce(F.schema_of_variant(variant) == "STRING", F.lit(False))


def _string(variant: Column) -> Column:
    """The value of a JSON string; NULL for any other kind of value."""
    return F.when(_is_string(variant), variant.cast("string"))


def _string_map(variants: Column) -> Column:
    """The strings of a map of JSON values, the first of a repeated name; empty when there is no map."""
    strings = F.filter(F.map_entries(variants), lambda entry: _is_string(entry["value"]))
    names = F.transform(strings, lambda entry: entry["key"])
    first = F.filter(strings, lambda entry, i: F.array_position(names, entry["key"]) == i + 1)
    texts = F.transform(first, lambda entry: F.struct(entry["key"].alias("key"), entry["value"].cast("string").alias("value")))
    return F.coalesce(F.map_from_entries(texts), empty_map())


# What ``data`` of each kind of payload is read as: raw text of the elements, where possible.
_DATA_SCHEMAS = {
    STREAMS: "struct<resultType:variant,result:array<string>>",
    STRING_ARRAY: "array<variant>",
    SERIES: "array<string>",
}


def _accepted(data: Column, kind: str) -> Column:
    if kind == STREAMS:
        return F.coalesce(_string(data["resultType"]) == STREAMS, F.lit(False))
    return data.isNotNull()


def _refusal(body: Column, kind: str) -> Column:
    """Why a payload that is not accepted is refused."""
    raw = _only_data(_documents(body, "struct<data:string>"))
    if kind == STREAMS:
        result_type = _string(_parse(raw, "resultType variant")["resultType"])
        present = F.concat(F.lit("resultType is "), F.coalesce(result_type, F.lit("(none)")))
    else:
        present = F.lit("missing data")
    is_json = F.size(_documents(body, "string")) == 1
    absent = F.when(is_json, F.lit("missing data")).otherwise(F.lit("not valid JSON"))
    return F.when(raw.isNull(), absent).otherwise(present)


def _with_data(df: DataFrame, body: str, kind: str) -> DataFrame:
    if kind not in KINDS:
        raise ValueError(f"unknown payload kind {kind!r}, expected one of {KINDS}")
    # Two steps, so that the document is parsed once although it is looked at twice.
    documents = df.withColumn("__documents", _documents(F.col(body), f"struct<data:{_DATA_SCHEMAS[kind]}>"))
    return documents.withColumn("__data", _only_data(F.col("__documents"))).drop("__documents")


def _elements(df: DataFrame, body: str, kind: str, on_invalid: str, keep: Iterable[str] = ()) -> DataFrame:
    """One row per element of ``data``; invalid payloads fail the job or give no rows."""
    if on_invalid not in ("fail", "skip"):
        raise ValueError("on_invalid must be 'fail' or 'skip'")
    data = F.col("__data")
    elements = data["result"] if kind == STREAMS else data
    message = F.concat(F.lit("invalid payload, "), _refusal(F.col(body), kind), F.lit(": "), _snippet(F.col(body)))
    failure = F.raise_error(message) if on_invalid == "fail" else F.lit(None)
    checked = F.when(_accepted(data, kind), elements).otherwise(failure)
    return _exploded(_with_data(df, body, kind), checked, "__element", keep)


def _exploded(df: DataFrame, array: Column, name: str, keep: Iterable[str]) -> DataFrame:
    """One row per element, null ones too.  The outer form keeps Spark from computing ``array`` twice to skip empty ones."""
    rows = df.select(*keep, F.posexplode_outer(array).alias("__place", name))
    return rows.where(F.col("__place").isNotNull()).drop("__place")


def payload_rejects(df: DataFrame, body: str = "body", kind: str = STREAMS) -> DataFrame:
    """The payloads a parse would refuse: the other columns, ``reason`` and a ``snippet`` of the body."""
    refused = _with_data(df, body, kind).where(~_accepted(F.col("__data"), kind))
    others = [name for name in df.columns if name != body]
    return refused.select(*others, _refusal(F.col(body), kind).alias("reason"), _snippet(F.col(body)).alias("snippet"))


def parse_streams(
    df: DataFrame, body: str = "body", *, on_invalid: str = "fail", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Entries of stream payloads, as a log table without promoted labels.

    An entry whose time is not a number is skipped; a missing line is the empty
    string; of repeated names the first counts.  ``keep`` passes columns of ``df`` (such as the tenant) through.
    """
    streams = _elements(df, body, STREAMS, on_invalid, keep)
    stream = _parse(F.col("__element"), "stream map<string,variant>, values array<string>")
    labelled = streams.select(*keep, stream.alias("__stream")).select(
        *keep, _string_map(F.col("__stream.stream")).alias(LABELS), F.col("__stream.values").alias("__values")
    )
    # Parsed before the explode: a filter on the time would otherwise parse every entry once more.
    # In two steps, as a lambda would parse the text anew wherever it is looked at.
    texts = F.transform("__values", lambda text: F.struct(text.alias("text"), _parse(text, "array<variant>").alias("whole")))
    entries = _exploded(labelled, F.transform(texts, _entry), "__entry", [*keep, LABELS])
    rows = entries.select(
        *keep,
        _integer(_string(F.get("__entry.parts", F.lit(0)))).alias(TS_NS),
        F.coalesce(_string(F.get("__entry.parts", F.lit(1))), F.lit("")).alias(LINE),
        LABELS,
        _string_map(F.col("__entry.metadata")).alias(METADATA),
    )
    timed = rows.where(F.col(TS_NS).isNotNull())
    return timed.select(*keep, TS_NS, timestamp_of(F.col(TS_NS)).alias(TIMESTAMP), LINE, LABELS, METADATA)


# Time and line at the start of an entry's text: two JSON strings or other scalars.
_HEAD = r'^\s*\[\s*("(?:[^"\\]++|\\.)*+"|[^"\[\]{},\s]++)\s*(?:,\s*("(?:[^"\\]++|\\.)*+"|[^"\[\]{},\s]++)\s*)?[,\]]'


def _entry(entry: Column) -> Column:
    """Time, line and metadata of an entry, given as its text and, if it is one, array of variants: ``struct<parts:array<variant>,metadata:map<string,variant>>``.

    An object that holds a name twice, wherever in the entry, is no variant.  Such an entry is read
    from its text: the first two elements, and of the third the first ``structuredMetadata``.
    """
    text, whole = entry["text"], entry["whole"]
    metadata = F.try_variant_get(F.get(whole, F.lit(2)), "$.structuredMetadata", "map<string,variant>")
    second = F.regexp_extract(text, _HEAD, 2)
    head = F.concat(F.lit("["), F.regexp_extract(text, _HEAD, 1), F.when(second != "", F.concat(F.lit(","), second)).otherwise(F.lit("")), F.lit("]"))
    third = _parse(F.get(_parse(text, "array<string>"), F.lit(2)), "map<string,string>")
    named = F.filter(F.map_entries(third), lambda entry: entry["key"] == "structuredMetadata")
    repeated = _parse(F.get(named, F.lit(0))["value"], "map<string,variant>")
    return F.when(whole.isNotNull(), F.struct(whole.alias("parts"), metadata.alias("metadata"))).otherwise(
        F.struct(_parse(head, "array<variant>").alias("parts"), repeated.alias("metadata"))
    )


def _integer(text: Column) -> Column:
    """The integer a text starts with (anything may follow); NULL if none or out of range."""
    leading = F.regexp_extract(text, r"^\s*([+-]?[0-9]+)", 1)
    return F.coalesce(text.try_cast("bigint"), leading.try_cast("bigint"))


def parse_string_array(df: DataFrame, body: str = "body", *, on_invalid: str = "fail") -> DataFrame:
    """The strings of list payloads, one per row, as ``value``; other elements are skipped."""
    elements = _elements(df, body, STRING_ARRAY, on_invalid)
    return elements.select(_string(F.col("__element")).alias("value")).where(F.col("value").isNotNull())


def parse_series(df: DataFrame, body: str = "body", *, on_invalid: str = "fail") -> DataFrame:
    """The label sets of series payloads, one per row, as ``labels``; non-string values are skipped.

    An element that is no object, null included, is an empty set.
    """
    elements = _elements(df, body, SERIES, on_invalid)
    return elements.select(_string_map(_parse(F.col("__element"), "map<string,variant>")).alias(LABELS))
