"""Attaching a log table: read-only views per tenant.

``attach`` registers three temporary views per tenant, named
``<alias>_<tenant>_logs``, ``.._labels`` and ``.._series`` (tenant ``public`` when
the table is not split).  The views are uncapped and unwindowed: filters stated in
SQL reach the scan through them.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from logframe.functions.timebounds import TimeBound, explicit_window, time_filter
from logframe.model import (
    DAY,
    LABELS,
    LINE,
    METADATA,
    TENANT,
    TIMESTAMP,
    TS_NS,
    check_label_names,
    label_column,
    promoted,
    quoted,
)
from logframe.operators.discover import label_names, series_of
from logframe.sources.series_index import has_index, indexed_series
from logframe.sources.tables import read_logs

DEFAULT_TENANT = "public"
TABLES = ("logs", "labels", "series")


def string_list(value: str | Iterable[str | None] | None) -> list[str]:
    """A list option: a list, or comma-separated text; blank and missing parts are dropped."""
    if value is None:
        return []
    if isinstance(value, str):
        return [part.strip() for part in value.split(",") if part.strip()]
    return [str(part) for part in value if part is not None]


@dataclass(frozen=True)
class Attached:
    """The views of one ``attach``."""

    alias: str
    labels: dict[str, list[str]] = field(default_factory=dict)

    @property
    def tenants(self) -> list[str]:
        return list(self.labels)

    def view_name(self, table: str = "logs", tenant: str | None = None) -> str:
        """Name of a view, quoted for SQL; tenant and table are looked up ignoring case."""
        wanted = self.tenants[0] if tenant is None else tenant
        tenants = {name.lower(): name for name in self.tenants}
        if wanted.lower() not in tenants:
            raise ValueError(f"no tenant {wanted!r} in {self.alias!r}")
        if table.lower() not in TABLES:
            raise ValueError(f"no table {table!r}, expected one of {TABLES}")
        return quoted(f"{self.alias}_{tenants[wanted.lower()]}_{table.lower()}")

    def table(self, spark: SparkSession, table: str = "logs", tenant: str | None = None) -> DataFrame:
        return spark.table(self.view_name(table, tenant))


def attach(
    spark: SparkSession,
    source: str | DataFrame,
    alias: str,
    *,
    tenants: str | Iterable[str] | None = None,
    labels: str | Iterable[str] | None = None,
    start: TimeBound | None = None,
    end: TimeBound | None = None,
    now: TimeBound | None = None,
) -> Attached:
    """Register the views of a log table (a path, or a DataFrame of that shape).

    ``labels`` pins the promoted columns, an empty list promotes none; left out, one
    job finds the names present, for all tenants.  ``tenants`` gives one set of views per
    entry.  ``start``/``end`` bound all views.  For a path whose table has a side table of label sets the
    names and the views of labels and series come from that, as it is at that moment; attach again to refresh them.
    """
    df = read_logs(spark, source) if isinstance(source, str) else source
    wanted = string_list(tenants)
    if wanted and TENANT not in df.columns:
        raise ValueError(f"the table has no {TENANT!r} column to split by")
    predicate = time_filter(explicit_window(start, end, now), df)
    bounded = df if predicate is None else df.where(predicate)
    attached = Attached(alias, {})
    known = bounded
    if isinstance(source, str) and has_index(spark, source):
        known = indexed_series(spark, source, start=start, end=end, now=now, tenants=wanted)
    found = _discovered(known, wanted) if labels is None else {}
    for tenant in wanted or [DEFAULT_TENANT]:
        # Always a filter: Spark refuses to insert into a view that is not a bare table.
        own = bounded.where(F.col(TENANT) == tenant) if wanted else bounded.where(F.col(TS_NS).isNotNull())
        attached.labels[tenant] = check_label_names(found[tenant] if labels is None else string_list(labels))
        _register(own, own if known is bounded else known.where(F.col(TENANT) == tenant) if wanted else known, attached, tenant)
    return attached


def _discovered(df: DataFrame, tenants: list[str]) -> dict[str, list[str]]:
    """The label names of each tenant, found in one job.  They become columns, so their number is that of a schema."""
    own = F.col(TENANT) if tenants else F.lit(DEFAULT_TENANT)
    rows = df.where(F.col(TENANT).isin(tenants)) if tenants else df
    names = rows.select(own.alias("own"), F.explode(F.map_keys(LABELS)).alias("label")).distinct().collect()
    found: dict[str, list[str]] = {tenant: [] for tenant in tenants or [DEFAULT_TENANT]}
    for row in names:
        found[row.own].append(row.label)
    return {tenant: sorted(labels) for tenant, labels in found.items()}


def _register(df: DataFrame, known: DataFrame, attached: Attached, tenant: str) -> None:
    names = attached.labels[tenant]
    columns = [promoted(label_column(df, name), name) for name in names]
    time_columns = [TIMESTAMP, TS_NS, *([DAY] if DAY in df.columns else [])]
    logs = df.select(*time_columns, LINE, *columns, LABELS, METADATA)
    logs.createOrReplaceTempView(attached.view_name("logs", tenant))
    label_names(known).createOrReplaceTempView(attached.view_name("labels", tenant))
    series_of(known, names).createOrReplaceTempView(attached.view_name("series", tenant))
