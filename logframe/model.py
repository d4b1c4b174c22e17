"""The log table: one row per log entry, as an ordinary DataFrame.

Columns of a log table

========================  ======================  =====================================
``tenant`` (optional)     STRING                  isolation key, partition column
``day`` (at rest)         DATE                    UTC day of ``ts_ns``, partition column
``ts_ns``                 BIGINT                  exact nanoseconds since the epoch
``timestamp``             TIMESTAMP_NTZ           UTC, floored to microseconds
``line``                  STRING                  raw text, never NULL
one per promoted label    STRING                  NULL where the stream lacks the label
``labels``                MAP<STRING,STRING>      all labels of the stream
``structured_metadata``   MAP<STRING,STRING>      per entry, empty when absent
``labels_key``            STRING                  canonical JSON of ``labels``
``stream_id`` (at rest)   BIGINT                  hash of ``labels_key``
========================  ======================  =====================================

A label is promoted by giving it a top-level STRING column of its name.  Parquet
keeps statistics and dictionaries for such columns but not for map entries, so
promotion is the storage choice that makes label predicates cheap.

Maps cannot be sorted or de-duplicated, so whatever needs that uses
``labels_key``: JSON with sorted names, which is injective for any label text.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from logframe.functions.timebounds import STORED_TIME, day_of, timestamp_of

TENANT = "tenant"
DAY = "day"
TS_NS = "ts_ns"
TIMESTAMP = "timestamp"
LINE = "line"
LABELS = "labels"
METADATA = "structured_metadata"
LABELS_KEY = "labels_key"
STREAM_ID = "stream_id"

RESERVED_COLUMNS = (TENANT, DAY, TS_NS, TIMESTAMP, LINE, LABELS, METADATA, LABELS_KEY, STREAM_ID)

STRING_MAP = "map<string,string>"


def empty_map() -> Column:
    return F.expr(f"cast(map() as {STRING_MAP})")


def canonical_map(map_column: Column) -> Column:
    """Canonical JSON text of a string map: equal maps give equal text, and only they do."""
    ordered = F.map_from_entries(F.array_sort(F.map_entries(map_column)))
    return F.coalesce(F.to_json(ordered), F.lit("{}"))


def label_map_of_key(labels_key: Column) -> Column:
    """Inverse of the canonical JSON."""
    return F.from_json(labels_key, STRING_MAP)


def labels_key_of(df: DataFrame) -> Column:
    """The stored ``labels_key`` if the table has one, else the same text computed."""
    return F.col(LABELS_KEY) if LABELS_KEY in df.columns else canonical_map(F.col(LABELS))


def stream_id_of(labels_key: Column) -> Column:
    """The number that entries at rest carry for their label set."""
    return F.xxhash64(labels_key)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def check_label_names(names: Iterable[str | None]) -> list[str]:
    """Validate a list of labels to promote (declared order is kept)."""
    if isinstance(names, str):
        raise ValueError("labels must be a list of names")
    checked: list[str] = []
    for name in names:
        if name is None:
            raise ValueError("a label name is missing (None)")
        if name.lower() in RESERVED_COLUMNS:
            raise ValueError(f"label {name!r} collides with a column of the log table")
        if name.lower() in (other.lower() for other in checked):
            raise ValueError(f"label {name!r} is listed twice")
        checked.append(name)
    return checked


# Schema metadata: the column is a promoted label. Parquet keeps it.
PROMOTED = {"promoted_label": True}


def is_promoted(df: DataFrame, name: str) -> bool:
    """Whether a column of that name is the label of that name; other columns never stand for a label."""
    return name in df.columns and bool(df.schema[name].metadata.get("promoted_label"))


def promoted(column: Column, name: str) -> Column:
    """``column`` as the promoted label ``name``."""
    return column.alias(name, metadata=PROMOTED)


def label_column(df: DataFrame, name: str) -> Column:
    """The promoted column of a label if the table has one, else its map entry."""
    return F.col(quoted(name)) if is_promoted(df, name) else F.col(LABELS)[name]


def log_table(
    df: DataFrame,
    *,
    ts_ns: Column,
    line: Column,
    labels: Mapping[str, Column] | Column,
    metadata: Mapping[str, Column] | Column | None = None,
    tenant: Column | None = None,
    timestamp: Column | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Shape any DataFrame into a log table.

    With ``labels`` given as ``{name: column}`` every label is promoted; given as
    a map column none is.  ``timestamp`` names the stored UTC column that ``ts_ns`` is
    computed from, if there is one: time windows are then stated on it too, so that
    the scan can prune.  ``keep`` passes further columns through.
    """
    # What maps are made of is computed once, before them, and not again for every place that it has there.
    given = {}
    labels, metadata = (_named(values, kind, given) for kind, values in (("label", labels), ("meta", metadata)))
    df = df.select("*", *given.values())
    columns = [] if tenant is None else [tenant.cast("string").alias(TENANT)]
    columns += [
        ts_ns.cast("bigint").alias(TS_NS),
        timestamp_of(ts_ns).alias(TIMESTAMP) if timestamp is None else timestamp.alias(TIMESTAMP, metadata=STORED_TIME),
        F.coalesce(line, F.lit("")).alias(LINE),
    ]
    if isinstance(labels, Mapping):
        check_label_names(labels)
        columns += [promoted(labels[name].cast("string"), name) for name in labels]
        columns += [
            _map_without_nulls(labels).alias(LABELS),
            F.to_json(F.struct(*(labels[name].cast("string").alias(name) for name in sorted(labels)))).alias(LABELS_KEY),
        ]
    else:
        columns.append(F.coalesce(labels, empty_map()).alias(LABELS))
    if metadata is None:
        metadata_map = empty_map()
    elif isinstance(metadata, Mapping):
        metadata_map = _map_without_nulls(metadata)
    else:
        metadata_map = F.coalesce(metadata, empty_map())
    columns.append(metadata_map.alias(METADATA))
    return df.select(*columns, *(F.col(quoted(name)) for name in keep))


def _named(values, kind: str, given: dict[str, Column]):
    """The values of a map as columns, which are put into ``given``; other values as they are."""
    if not isinstance(values, Mapping):
        return values
    names = {name: f"__{kind}_{k}" for k, name in enumerate(values)}
    given.update({names[name]: value.cast("string").alias(names[name]) for name, value in values.items()})
    return {name: F.col(names[name]) for name in names}


#: Up to so many values a map without nulls is a choice among all its forms, which is compiled; filtering a map is interpreted.
_CHOSEN = 3


def _map_without_nulls(values: Mapping[str, Column]) -> Column:
    if not values:
        return empty_map()
    values = {name: value.cast("string") for name, value in values.items()}
    if len(values) <= _CHOSEN:
        return _map_of_present(list(values.items()), [])
    pairs = [part for name, value in values.items() for part in (F.lit(name), value)]
    return F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())


def _map_of_present(values: list[tuple[str, Column]], pairs: list[Column]) -> Column:
    """The map of ``pairs`` and of those values that are not null."""
    if not values:
        return F.create_map(*pairs) if pairs else empty_map()
    (name, value), *others = values
    return F.when(value.isNull(), _map_of_present(others, pairs)).otherwise(_map_of_present(others, [*pairs, F.lit(name), value]))


def with_layout_columns(df: DataFrame) -> DataFrame:
    """Add ``day``, ``labels_key`` and ``stream_id`` where missing, as tables at rest carry them."""
    if LABELS_KEY not in df.columns:
        df = df.withColumn(LABELS_KEY, canonical_map(F.col(LABELS)))
    if STREAM_ID not in df.columns:
        df = df.withColumn(STREAM_ID, stream_id_of(F.col(LABELS_KEY)))
    if DAY not in df.columns:
        df = df.withColumn(DAY, day_of(F.col(TS_NS)))
    return df
