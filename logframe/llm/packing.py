"""Packing of tokenized documents into sequences, shortest pack first.

The lengths of all pieces are counted into a histogram of at most ``size`` bins.  Over that
histogram, lengths are placed longest first, each into the shortest pack there is, the one with most room, and
into a new one only if it fits into none.  Only counts of packing patterns change and no document is looked at.
The patterns are then joined back to the pieces by rank: the r-th piece of a length takes the r-th place
that the patterns have for that length.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from logframe.llm.common import mapped, text_rows, written

_encoders: dict[str, "Encoder"] = {}


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """The path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: The pre-tokenizer's pattern without its look-ahead: the same wherever no two white spaces meet.
SINGLE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
MEET = re.compile(r"\s\s")


class Encoder:
    """Ids of texts by a byte-level BPE vocabulary, those the ``tokenizers`` library gives for it.

    The vocabulary is read as ranks, which encode several times faster than the library's own
    file; the strings of special tokens are those tokens.
    """

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        special = {"<|endoftext|>": len(ranks)}
        single, any_ = (tiktoken.Encoding(f"{path} {p}", pat_str=p, mergeable_ranks=ranks, special_tokens=special) for p in (SINGLE, public_tokenizers.PATTERN))
        self.single, self.any, self.special = single, any_, set(special)

    def __call__(self, text: str) -> np.ndarray:
        """The ids as unsigned 32-bit numbers."""
        of = self.any if MEET.search(text) else self.single
        return of.encode_to_numpy(text, allowed_special=self.special, disallowed_special=())


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(df: DataFrame, size: int = 2048, id: str = "doc_id", text: str = "text", path: str | None = None, end: int = 1, keep_ids: bool = False) -> DataFrame:
    """The pieces of every row's ids: ``doc_id, start, length, ids_crc32, doc_tokens, task, nth``.

    A row has the ids of its text (null: none) and then ``end``.  It is cut every ``size`` ids.
    ``task, nth`` number the pieces of each length within a scan task.  With ``keep_ids`` there is
    the binary column ``ids`` (little-endian unsigned 32-bit) too.
    """
    path = path or vocabulary()
    last = np.array([end], "<u4")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "nth"] + ["ids"] * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen, encode = TaskContext.get().partitionId(), [0] * (size + 1), encoder(path)
        for ids, texts in text_rows(batches):
            out: list[tuple] = []
            for key, text in zip(ids, texts):
                found = np.append(encode(text or ""), last)
                for start in range(0, len(found), size):
                    part = found[start : start + size].tobytes()
                    length = len(part) // 4
                    out.append((key, start, length, zlib.crc32(part), len(found), task, seen[length], part))
                    seen[length] += 1
            columns = list(zip(*out))[: len(names)]
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.binary()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, nth long"
    rows = df.select(F.col(id).cast("long"), F.col(text).cast("string"))
    return rows.transform(mapped, cut, schema + ", ids binary" * keep_ids)


#: Lengths of a pattern in order, and how often each stands there.
Pattern = tuple[tuple[int, int], ...]


def patterns(histogram: dict[int, int], size: int) -> list[tuple[int, Pattern]]:
    """``(count, pattern)`` for the counted lengths: what placing piece by piece, each into the pack with most room, gives.

    All packs of a pattern are changed at once, and a new pack takes as many pieces of its length as there
    are room and pieces for.  A length splits one pattern at most and opens two, so there are at most ``3 * size``.
    """
    by_room: dict[int, list[tuple[int, Pattern]]] = defaultdict(list)
    rooms: list[int] = []  # a heap of those in use, negative

    def put(room: int, count: int, pattern: Pattern) -> None:
        if room and not by_room[room]:
            heapq.heappush(rooms, -room)
        by_room[room].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and rooms and -rooms[0] >= length:
            room = -rooms[0]
            count, pattern = by_room[room].pop()
            if not by_room[room]:
                heapq.heappop(rooms)
            used = min(count, left)
            if used < count:
                put(room, count - used, pattern)
            *rest, (last, times) = pattern
            put(room - length, used, (*rest, (last, times + 1)) if last == length else (*pattern, (length, 1)))
            left -= used
        most = size // length
        if left >= most:
            put(size - most * length, left // most, ((length, most),))
        if left % most:
            put(size - left % most * length, 1, ((length, left % most),))
    return [p for room in sorted(by_room) for p in by_room[room]]


def places(found: list[tuple[int, Pattern]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: the first rank of each run of places, its first sequence, its offset there, its places in each sequence."""
    runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    sequence = 0
    for count, pattern in found:
        offset = 0
        for length, times in pattern:
            runs[length].append((taken[length], sequence, offset, times))
            taken[length] += count * times
            offset += length * times
        sequence += count
    return {length: tuple(np.array(x) for x in zip(*r)) for length, r in runs.items()}


def pack(df: DataFrame, size: int = 2048, **options) -> DataFrame:
    """Pack the rows of ``df``: one row per piece with ``sequence_id, offset`` next to what ``pieces`` gives.

    Every id lies in exactly one piece, and the pieces of a sequence fill it from 0 without a gap.
    Null and empty texts have the end id alone; rows without an id and repeated rows are packed like
    others.  An empty table gives no rows.  Only id and text are read, so other columns cannot clash.
    The patterns are worked out on the driver from the histogram (at most ``size`` bins) and
    sent to the tasks; their number is bounded by ``size`` too, whatever the number of documents.
    """
    cut = written(pieces(df, size, **options), "pieces")
    counts = written(cut.groupBy("task", "length").agg(F.count("*").alias("n")), "counts")
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("task").alias("t"), F.col("length").alias("l"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    sent = df.sparkSession.sparkContext.broadcast(places(patterns(histogram, size)))

    # Never broadcast: the counts grow with the number of tasks, and much smaller as files than in memory.
    ranked = cut.join(before.hint("merge"), (cut.task == before.t) & (cut.length == before.l))
    columns = [c for c in cut.columns if c not in ("task", "nth")]
    ranked = ranked.select(*columns, (F.col("nth") + F.col("before")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                first, base, at, times = sent.value[int(length[rows[0]])]
                run = np.searchsorted(first, rank[rows], "right") - 1
                nth, again = np.divmod(rank[rows] - first[run], times[run])
                sequence[rows] = base[run] + nth
                offset[rows] = at[run] + again * length[rows]
            data = [batch.column(c) for c in columns] + [pa.array(sequence), pa.array(offset)]
            yield pa.record_batch(data, [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"{c} {t}" for c, t in ranked.select(columns).dtypes)
    return ranked.transform(mapped, place, schema + ", sequence_id long, offset long")
