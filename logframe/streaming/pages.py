"""Merging overlapping result pages as they arrive."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from logframe.functions.timebounds import NANOS_PER_MICRO, floor_div, timestamp_of
from logframe.model import LABELS, LABELS_KEY, LINE, METADATA, STRING_MAP, TIMESTAMP, TS_NS, canonical_map, labels_key_of, quoted
from logframe.operators.pages import entry_digest

_ROW = f"{TS_NS} long, {LINE} string, {LABELS_KEY} string, metadata string"
#: Entries are dealt by hash to so many groups, each with one state: Python is called per group and batch, not per entry.
GROUPS = 1024


def _new_copies(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The copies by which the largest pages of a group's entries have grown.

    The state is, per entry, its instant, the copies that were put out, and the number of its copies on every page.
    """
    entries = json.loads(state.get[0]) if state.exists else {}
    if not state.hasTimedOut:
        for frame in frames:
            grown = []
            for entry, instant, page in zip(frame["entry"], frame["instant"].tolist(), frame["page"]):
                kept = entries.setdefault(entry, [instant, 0, {}])
                copies = kept[2][page] = kept[2].get(page, 0) + 1
                grown.append(copies > kept[1])
                kept[1] = max(kept[1], copies)
            if any(grown):
                yield frame.loc[grown, [TS_NS, LINE, LABELS_KEY, "metadata"]]
    passed = state.getCurrentWatermarkMs()
    entries = {entry: kept for entry, kept in entries.items() if kept[0] >= passed}
    if entries:
        state.update((json.dumps(entries, separators=(",", ":")),))
        state.setTimeoutTimestamp(min(kept[0] for kept in entries.values()) + 1)
    elif state.exists:
        state.remove()


def merge_pages_stream(pages: DataFrame, delay: str, page: str = "page_id") -> DataFrame:
    """A stream of pages combined, each entry once per real copy, as :func:`merge_pages` does for a table.

    An entry has as many copies as the page that holds most of them.  They are put out as soon as a page has
    more than all pages before it, so nothing waits for a later page.  What is kept per entry is the number of its copies on every page that held it,
    until the watermark passes its time: pages that arrive more than ``delay`` behind the newest entry are not merged but
    dropped.  Entries are kept together in ``GROUPS`` groups.  Metadata is that of the copy that came first.  Entries without a time are left out.
    """
    timed = pages.where(F.col(TS_NS).isNotNull())
    metadata = canonical_map(F.col(METADATA)) if METADATA in pages.columns else F.lit("{}")
    rows = timed.select(
        F.timestamp_micros(floor_div(F.col(TS_NS), NANOS_PER_MICRO)).alias("event"),
        floor_div(F.col(TS_NS), 1_000_000).alias("instant"),
        F.concat(F.col(TS_NS).cast("string"), F.lit(":"), F.base64(F.unhex(entry_digest(pages)))).alias("entry"),
        F.coalesce(F.concat(F.lit("="), F.col(quoted(page)).cast("string")), F.lit("")).alias("page"),
        TS_NS, LINE, labels_key_of(pages).alias(LABELS_KEY), metadata.alias("metadata"),
    ).withWatermark("event", delay)
    grouped = rows.withColumn("group", F.pmod(F.xxhash64("entry"), F.lit(GROUPS))).groupBy("group")
    merged = grouped.applyInPandasWithState(_new_copies, _ROW, "copies string", "append", GroupStateTimeout.EventTimeTimeout)
    maps = {LABELS: F.col(LABELS_KEY), METADATA: F.col("metadata")}
    return merged.select(TS_NS, timestamp_of(F.col(TS_NS)).alias(TIMESTAMP), LINE, *(F.from_json(text, STRING_MAP).alias(name) for name, text in maps.items()), LABELS_KEY)
