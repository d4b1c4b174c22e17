"""Shards of near equal bytes: the minimax contiguous partition of groups of equal texts.

Groups are ordered by their smallest id and never cut.  The smallest capacity that a greedy cut into
the wanted number of shards can keep is found by binary search.  The greedy check needs the
running sums only near its cuts, so the driver looks at sums over ranges of ids: about ``CELLS``
of them at first, of which those that a cut may fall into are divided further until every cut lies
between two groups.  What the driver holds is bounded by ``CELLS``, whatever the number of groups.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from logframe.llm.common import ranked, written

CELLS = 4096


@dataclass(frozen=True)
class Cell:
    """The groups with smallest ids from ``low`` to ``high``, both of which are there; their bytes; the first range that they lie in."""

    low: int
    high: int
    total: int
    root: int

    @property
    def whole(self) -> bool:
        """Whether it cannot be cut."""
        return self.low == self.high


def cut_whole(cells: list[Cell], capacity: int) -> list[int]:
    """Greedy cuts between cells only: where each shard but the first begins."""
    cuts, held = [], 0
    for i, cell in enumerate(cells):
        if i and held + cell.total > capacity:
            cuts.append(i)
            held = 0
        held += cell.total
    return cuts


def cut_anywhere(cells: list[Cell], capacity: int) -> list[int]:
    """Greedy cuts where cells of several groups may be cut at any byte: the cell of each cut."""
    cuts, held = [], 0
    for i, cell in enumerate(cells):
        if held + cell.total <= capacity:
            held += cell.total
        elif cell.whole:
            cuts.append(i)
            held = cell.total
        else:
            left = cell.total - (capacity - held)
            more = -(-left // capacity)
            cuts += [i] * more
            held = left - (more - 1) * capacity
    return cuts


def smallest(fits, low: int, high: int) -> int:
    """The smallest capacity from ``low`` to ``high`` that fits; ``high`` does."""
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return high


def position(low: Column, width: Column) -> Column:
    """In which range of ``width`` ids a row's key lies, counted from ``low``, without overflow."""
    return F.floor((F.col("key").cast("decimal(20,0)") - low.cast("decimal(20,0)")) / width.cast("decimal(20,0)")).cast("long")


def histogram(groups: DataFrame) -> list[Cell]:
    """Sums over ``CELLS`` ranges of ``groups(key, total)``; ``groups`` gets its column ``root`` from the caller."""
    rows = groups.groupBy("root").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.sum("total").alias("total"))
    return sorted((Cell(r.low, r.high, r.total, r.root) for r in rows.collect()), key=lambda c: c.low)


def divided(groups: DataFrame, cells: list[Cell]) -> list[Cell]:
    """The cells, each cut into several ranges of ids; one pass over the groups in them."""
    parts = max(2, 4 * CELLS // len(cells))  # so that a few times CELLS rows come back
    ranges = [(c.root, i, c.low, c.high, max(1, -(-(c.high - c.low + 1) // parts))) for i, c in enumerate(cells)]
    spark = groups.sparkSession
    at = spark.createDataFrame(ranges, "at long, cell int, low long, high long, width long")
    found = groups.join(F.broadcast(at), (F.col("root") == F.col("at")) & F.col("key").between(F.col("low"), F.col("high")))
    rows = found.groupBy("root", "cell", position(F.col("low"), F.col("width")).alias("part")).agg(F.min("key").alias("a"), F.max("key").alias("b"), F.sum("total").alias("total"))
    return [Cell(r.a, r.b, r.total, r.root) for r in rows.collect()]


def capacity_and_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The least capacity of ``shards`` contiguous shards of ``groups(key, total)``, and the keys that begin
    the second and each further shard."""
    ends = groups.agg(F.min("key").alias("low"), F.max("key").alias("high")).first()
    if ends.low is None:
        return 0, []
    width = F.lit(max(1, -(-(ends.high - ends.low + 1) // CELLS)))
    groups = groups.withColumn("root", position(F.lit(ends.low), width))
    cells = histogram(groups)
    while True:
        total = sum(c.total for c in cells)
        floor = max(-(-total // shards), max(c.total if c.whole else 0 for c in cells))
        high = smallest(lambda c: c >= max(x.total for x in cells) and len(cut_whole(cells, c)) < shards, floor, total)
        low = smallest(lambda c: len(cut_anywhere(cells, c)) < shards, floor, high)
        if low == high:
            return high, [cells[i].low for i in cut_whole(cells, high)]
        first, last = cut_whole(cells, low), cut_anywhere(cells, high)
        last += [len(cells) - 1] * (len(first) - len(last))
        near = {i for a, b in zip(first, last) for i in range(a, b + 1)}
        open_ = [c for i, c in enumerate(cells) if not c.whole and (i in near or i + 1 in near or c.total > low)]
        open_ = open_ or [c for c in cells if not c.whole]
        kept = set(open_)
        cells = sorted([c for c in cells if c not in kept] + divided(groups, open_), key=lambda c: c.low)


def shard(df: DataFrame, shards: int = 16, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Put every row of ``df`` into a shard: ``doc_id, size, text_crc32, shard, slot``.

    ``size`` is the text's UTF-8 bytes plus 1.  Rows of equal texts stay together, rows that share an id only if
    their texts are equal.  The largest shard is as small as contiguous shards of such groups can be.  Slots
    number a shard's rows by id, from 0 without a gap, dealt by ranges whatever the ids are like.  A null text has size 1, the check sum
    of no bytes, and is not equal to the empty text; a row without an id counts as id -1.  Fewer groups
    than shards leave shards empty, and an empty table gives no rows.  Only id and text are read.
    """
    value = F.col(text).cast("string")
    bytes_ = F.coalesce(value, F.lit("")).cast("binary")
    base = written(
        df.select(
            F.col(id).cast("long").alias("doc_id"),
            (F.octet_length(bytes_) + 1).cast("long").alias("size"),
            F.crc32(bytes_).alias("text_crc32"),
            F.coalesce(F.unhex(F.sha2(value.cast("binary"), 256)), F.lit("").cast("binary")).alias("digest"),
        ),
        "sizes",
    )
    key = F.coalesce(F.col("doc_id"), F.lit(-1))
    groups = written(base.groupBy("digest").agg(F.min(key).alias("key"), F.sum("size").alias("total")), "groups")
    _, cuts = capacity_and_cuts(groups.select("key", "total"), shards)
    at = sum((F.when(F.col("key") >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    of = groups.select(F.col("digest").alias("of"), at.cast("int").alias("shard"))
    dealt = base.join(of, base.digest == of.of).select("doc_id", "size", "text_crc32", F.col("shard").alias("tree"), key.alias("key"))
    # Rows that nothing tells apart are parted by the task they come from.
    numbered = ranked(dealt.withColumn("spread", F.spark_partition_id()), "key", "text_crc32", "spread")
    return numbered.select("doc_id", "size", "text_crc32", F.col("tree").alias("shard"), F.col("rank").alias("slot"))
