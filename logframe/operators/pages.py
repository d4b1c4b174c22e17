"""Merging overlapping result pages of one selection.

A paged read serves entries at a page edge again on the next page.  Entries are
the same when time, line and labels agree; metadata does not count.  Copies
inside one page are real, so an entry keeps as many copies as the page that holds
most of them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from logframe.functions.timebounds import Window
from logframe.model import LINE, TS_NS, labels_key_of, quoted
from logframe.operators.topk import check_direction, check_limit, first_rows, in_window, past_cut_off

_ENTRY = "__entry"
_KEY = [TS_NS, _ENTRY]


def entry_digest(df: DataFrame) -> Column:
    """Labels and line of an entry; NULL differs from every text."""
    parts = [F.coalesce(F.concat(F.lit("="), part), F.lit("-")) for part in (labels_key_of(df), F.col(LINE))]
    return F.sha2(F.concat(F.length(parts[0]).cast("string"), *parts), 256)


def merge_pages(pages: DataFrame, page: str = "page_id") -> DataFrame:
    """All pages of ``pages`` combined, each entry once per real copy; drops the page column.

    First the instants that more than one page serves are found, from times and page names alone,
    combined in the map tasks.  Only entries of those instants are hashed and counted
    per page, over a digest instead of the text.  Of entries seen on several pages the page
    with most copies wins, and an anti-join takes out the other pages' copies.  Rows do not
    move while the lists of instants and of losing copies are small enough for Spark to broadcast;
    beyond that a heavily repeated entry is an ordinary skewed join key that adaptive
    execution splits.  Entries without a time count as one instant.
    """
    name = F.struct(F.col(quoted(page)).alias("page"))
    instants = pages.groupBy(F.col(TS_NS).alias("s_ts")).agg(F.min(name).alias("first"), F.max(name).alias("last"))
    instants = instants.where(~F.col("first").eqNullSafe(F.col("last"))).select("s_ts", F.lit(True).alias("__shared"))
    marked = pages.join(instants, F.col(TS_NS).eqNullSafe(F.col("s_ts")), "left").drop("s_ts")
    tagged = marked.withColumn(_ENTRY, F.when(F.col("__shared"), entry_digest(pages)))

    counted = tagged.where("__shared").groupBy(*_KEY, F.col(quoted(page)).alias("page")).agg(F.count("*").alias("copies"))
    copies = counted.select(*_KEY, F.struct("copies", "page").alias("held"))
    winners = (
        copies.groupBy(*_KEY)
        .agg(F.max("held").alias("winner"), F.count("*").alias("seen_on"))
        .where(F.col("seen_on") > 1)
        .select(F.col(TS_NS).alias("w_ts"), F.col(_ENTRY).alias("w_entry"), "winner")
    )
    same = F.col(TS_NS).eqNullSafe(F.col("w_ts")) & (F.col(_ENTRY) == F.col("w_entry"))
    losers = (
        copies.join(winners, same)
        .where(~F.col("held").eqNullSafe(F.col("winner")))
        .select(F.col("w_ts").alias("l_ts"), F.col("w_entry").alias("l_entry"), F.col("held.page").alias("l_page"))
    )
    lost = (
        F.col(TS_NS).eqNullSafe(F.col("l_ts"))
        & (F.col(_ENTRY) == F.col("l_entry"))
        & F.col(quoted(page)).eqNullSafe(F.col("l_page"))
    )
    return tagged.join(losers, lost, "left_anti").drop(_ENTRY, "__shared", page)


def merge_pages_limited(
    pages: DataFrame,
    limit: int,
    direction: str = "backward",
    page: str = "page_id",
    window: Window = Window(),
    tie_breakers: Iterable[str] = (),
) -> DataFrame:
    """The first ``limit`` rows of the merged pages within ``window``, counted after de-duplication.

    Equal entries share their instant, so a cut-off in time commutes with merging: the
    pages are cut first, by counts per page, and only what is left is merged.
    """
    backward = check_direction(direction) == "backward"
    check_limit(limit)
    cut = past_cut_off(in_window(pages, window), limit, backward, window, page)
    return first_rows(merge_pages(cut, page), limit, backward, tie_breakers)
