"""Substring dedup by content-defined chunking.

A gear rolling hash over the last ``WINDOW`` bytes decides where a text is cut: of every ``CHOICE`` words in a row
the one with the best hash begins a chunk, so cuts depend on the content around them alone, move with it, and every
stretch of ``LEAST_WORDS`` words determines ``GRAM`` whole chunks in a row.  So many neighbouring chunks, a single one being
too common, are dealt by their digest and learn an earlier document that has them.  Chunks in a row that one earlier document has
in the same row are a passage as they are.  What a passage has beyond its whole chunks, and passages put together from several documents, are found
by windows of ``LEAST_WORDS`` words: such a window is looked up by digest if the chunks that it determines are shared
and no row of chunks holds it.  A window inside such a row is not looked up: an earlier document has it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from logframe.llm.common import mapped, removed, runs, text_rows, written, written_at

#: Bytes that the rolling hash sees.
WINDOW = 16
#: A cut is liked best where these bits are zero: every 16th byte. Bit 15 needs all of the window.
MASK = np.uint32(0xF000)
#: Of so many words in a row one begins a chunk.
CHOICE = 9
#: Neighbouring chunks that are digested together.
GRAM = 2
#: Longest chunk in bytes; longer ones, of very long words, are cut at this distance.
LONGEST = 512
#: Least words of a passage.
LEAST_WORDS = 51
#: A random number per byte value.
GEAR = np.random.default_rng(2024).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """The gear hash of the last ``WINDOW`` bytes at every byte."""
    h = GEAR[data]
    step = 1
    while step < WINDOW:  # h[i] = sum of gear[i - k] << k over the window, by doubling
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    return h


def candidates(data: np.ndarray, h: np.ndarray | None = None) -> np.ndarray:
    """Where content likes a cut best: positions that begin a character, after a window whose hash fits."""
    h = rolling(data) if h is None else h
    at = np.flatnonzero((h & MASK) == 0) + 1
    return at[(at < len(data)) & ((data[np.minimum(at, len(data) - 1)] & 0xC0) != 0x80)]


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words: between white space; in scripts without it every character is one."""
    raw = np.frombuffer(data, np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    after = np.append(raw[1:], np.uint8(0))
    alone = ((raw >= 0xE3) & (raw <= 0xE9)) | ((raw == 0xE0) & (after >= 0xB8) & (after <= 0xBB))  # Han, kana; Thai, Lao
    start = ~blank & (np.append(True, blank[:-1])[: len(raw)] | alone)
    start[3:] |= ~blank[3:] & alone[:-3]
    end = ~blank & np.append((blank | start)[1:], True)[: len(raw)]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def chosen(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The words that begin a chunk: of every ``CHOICE`` in a row that with a liked cut inside, then the least hash, then the last."""
    if len(start) < CHOICE:
        return start[:0]
    h = rolling(data)
    at = candidates(data, h)
    plain = np.searchsorted(at, end) == np.searchsorted(at, start, "right")
    places = np.arange(len(start), dtype=np.uint64)
    least = ((plain.astype(np.uint64) << np.uint64(32) | h[end - 1]) << np.uint64(30)) | (np.uint64((1 << 30) - 1) - places)
    size = 1
    while 2 * size <= CHOICE:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < CHOICE:
        least = np.minimum(least[: size - CHOICE], least[CHOICE - size :])
    found = (1 << 30) - 1 - (least & np.uint64((1 << 30) - 1)).astype(np.int64)
    return found[np.append(True, found[1:] != found[:-1])]


class Layout(NamedTuple):
    """A text's words, the words that begin chunks, and the borders of its chunks, all in bytes but ``cut``."""

    start: np.ndarray
    end: np.ndarray
    cut: np.ndarray
    border: np.ndarray


def layout(data: bytes) -> Layout:
    """How a text is cut."""
    raw = np.frombuffer(data, np.uint8)
    start, end = word_spans(data)
    cut = chosen(raw, start, end)
    borders, last = [0], 0
    for at in [*start[cut].tolist(), len(raw)]:
        while at - last > LONGEST:
            last += LONGEST
            while data[last] & 0xC0 == 0x80:
                last -= 1
            borders.append(last)
        if at > last:
            borders.append(at)
            last = at
    return Layout(start, end, cut, np.array(borders))


def cuts(data: bytes) -> list[int]:
    """The chunk borders of a text's bytes, 0 and the length included."""
    return layout(data).border.tolist()


def text_digest(data: bytes) -> int:
    """What Spark's ``xxhash64`` gives for a text."""
    return int(np.uint64(xxhash.xxh64_intdigest(data, 42)).view(np.int64))


def split(df: DataFrame, id: str, text: str, least: int) -> DataFrame:
    """``digest, doc_id, text_key, at`` of ``GRAM`` neighbouring chunks of the texts that have ``least`` words, ``at`` the first one's number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for ids, texts in text_rows(batches):
            digests, keys, names, places = [], [], [], []
            for key, value in zip(ids, texts):
                if key is None or not value or len(value) < 2 * least - 1 and value.isascii():
                    continue
                data = value.encode()
                parts = layout(data)
                if len(parts.start) < least:
                    continue
                view, border = memoryview(data), parts.border.tolist()
                digests.append(np.array([digest(view[a:b]) for a, b in zip(border, border[GRAM:])], np.uint64).view(np.int64))
                size = len(digests[-1])
                keys.append(np.full(size, key, np.int64))
                names.append(np.full(size, text_digest(data), np.int64))
                places.append(np.arange(size, dtype=np.int32))
            if keys:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in (digests, keys, names, places)], ["digest", "doc_id", "text_key", "at"])

    rows = df.select(F.col(id).cast("long"), F.col(text).cast("string"))
    return rows.transform(mapped, work, "digest long, doc_id long, text_key long, at int")


def holders(rows: DataFrame) -> DataFrame:
    """The chunks (with their neighbours) that several documents have, each with the place of an earlier document's: -1 if there is none.

    Rows are dealt by ranges of digest and document, so that a chunk of very many documents is dealt over several tasks.
    A task takes its first and its last digest for shared, as those may go on in another, and the first holder that it sees itself.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of the last digest: the first row seen, and the rows kept back while one document alone has it
        source, held, opening = None, [], True
        names = ["doc_id", "text_key", "at", "src_id", "src_key", "src_at"]

        def rated(data: pa.Table, first: list[np.ndarray], keep: np.ndarray) -> pa.RecordBatch:
            own = [data.column(k).to_numpy()[keep] for k in (1, 2, 3)]
            of = [f[keep] for f in first]
            of[2] = np.where(of[0] < own[0], of[2], -1)
            return pa.record_batch([pa.array(c) for c in (*own, *of)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            data = pa.Table.from_batches([*held, batch])
            digest, ids = data.column(0).to_numpy(), data.column(1).to_numpy()
            begin = runs(digest)
            length = np.diff(begin)
            first = [data.column(k).to_numpy()[begin[:-1]].copy() for k in (1, 2, 3)]
            if source is not None and source[0] == digest[0]:
                for column, value in zip(first, source[1:]):
                    column[0] = value
            shared = ids[begin[1:] - 1] != first[0]
            shared[0] |= opening
            opening = opening and len(length) == 1
            keep = np.repeat(shared, length)
            source = (digest[-1], *(f[-1] for f in first))
            held = [] if shared[-1] else data.slice(begin[-2]).combine_chunks().to_batches()
            yield rated(data, [np.repeat(f, length) for f in first], keep)
        if held:
            data = pa.Table.from_batches(held)
            yield rated(data, [np.full(data.num_rows, v) for v in source[1:]], np.ones(data.num_rows, bool))

    key = ("digest", "doc_id")
    dealt = rows.repartitionByRange(*key).sortWithinPartitions(*key, "text_key", "at")
    return dealt.transform(mapped, work, "doc_id long, text_key long, at int, src_id long, src_key long, src_at int")


def rows_of_chunks(parts: Layout, at: np.ndarray, src_id: np.ndarray, src_key: np.ndarray, src_at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, last word and earlier document of the rows of chunks that this document has in the same row."""
    goes_on = (np.diff(at) == 1) & (np.diff(src_at) == 1) & (src_id[1:] == src_id[:-1]) & (src_key[1:] == src_key[:-1])
    goes_on &= (src_at[1:] >= 0) & (src_at[:-1] >= 0)
    begin = np.flatnonzero(np.append(True, ~goes_on)) if len(at) else np.zeros(0, np.int64)
    last = np.append(begin[1:], len(at)) - 1
    first_word = np.searchsorted(parts.start, parts.border[at[begin]])
    last_word = np.searchsorted(parts.end, parts.border[at[last] + GRAM], "right") - 1
    good = (src_at[begin] >= 0) & (last_word - first_word + 1 >= least)
    return first_word[good], last_word[good], src_id[begin][good]


def windows_of(parts: Layout, at: np.ndarray, least: int) -> np.ndarray:
    """Whether the window of ``least`` words from each word may stand elsewhere, given the shared chunks.

    A window determines a chunk if the words that decide on its ends, and the bytes that their hashes see, lie inside.
    """
    n, chunks = len(parts.start), max(len(parts.border) - GRAM, 0)
    before, after = np.searchsorted(parts.start[parts.cut], parts.border[:chunks], "right") - 1, np.searchsorted(parts.start[parts.cut], parts.border[GRAM:])
    low, high = np.full(chunks, -1), np.full(chunks, n + least)
    if len(parts.cut):
        word = parts.cut[np.maximum(before, 0)] - CHOICE + 1
        low = np.where((before >= 0) & (word >= 0), parts.start[np.maximum(word, 0)], -1)
        high = np.where(after < len(parts.cut), parts.cut[np.minimum(after, len(parts.cut) - 1)] + CHOICE - 1, n + least)
    missing = np.ones(chunks, np.int64)
    missing[at] = 0
    lacking = np.append(0, np.cumsum(missing))
    first = np.arange(max(n - least + 1, 0))
    a = np.searchsorted(low, parts.start[first] + WINDOW)
    b = np.searchsorted(high, first + least - 1, "right")
    return (b <= a) | (lacking[b] == lacking[np.minimum(a, chunks)])


def look_ups(df: DataFrame, shared: DataFrame, id: str, text: str, least: int) -> DataFrame:
    """``w, doc_id, text_key, a, b, first_id``: windows to look up by digest, and passages known from chunks (no ``w``)."""
    per_row = shared.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("at", "src_id", "src_key", "src_at")).alias("c"))
    per_row = per_row.select(F.col("doc_id").alias("__of"), F.col("text_key").alias("__key"), "c")
    rows = df.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= least)).withColumn("text_key", F.xxhash64("text"))
    joined = rows.join(per_row.hint("merge"), (F.col("doc_id") == F.col("__of")) & (F.col("text_key") == F.col("__key")))
    names = ["w", "doc_id", "text_key", "a", "b", "first_id"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for key, name, value, c in zip(*(batch.column(k) for k in range(4))):
                data = value.as_py().encode()
                at, *src = (c.values.field(k).to_numpy() for k in ("at", "src_id", "src_key", "src_at"))
                at, nth = np.unique(at, return_index=True)
                src = [s[nth] for s in src]
                parts = layout(data)
                may = windows_of(parts, at, least)
                first, last, of = rows_of_chunks(parts, at, *src, least)
                for i, j in zip(first, last):
                    may[i : j - least + 2] = False
                a, b = parts.start[: len(may)][may], parts.end[least - 1 :][: len(may)][may]
                view = memoryview(data)
                ws = np.array([digest(view[x:y]) for x, y in zip(a.tolist(), b.tolist())], np.uint64).view(np.int64)
                size = len(a) + len(of)
                if size:
                    columns = [
                        pa.array(np.append(ws, np.zeros(len(of), np.int64)), mask=np.arange(size) >= len(a)),
                        pa.array(np.full(size, key.as_py())), pa.array(np.full(size, name.as_py())),
                        pa.array(np.append(a, parts.start[first]).astype(np.int32)), pa.array(np.append(b, parts.end[last]).astype(np.int32)),
                        pa.array(np.append(np.zeros(len(a), np.int64), of), mask=np.arange(size) < len(a)),
                    ]
                    yield pa.record_batch(columns, names)

    return joined.select("doc_id", "text_key", "text", "c").transform(mapped, work, "w long, doc_id long, text_key long, a int, b int, first_id long")


def later(windows: DataFrame) -> DataFrame:
    """Those of ``windows(w, doc_id, text_key, a, b)`` that an earlier document has, with its ``first_id``.

    They are dealt by ranges of digest and document.  Rows of the first document of a task's first digest
    depend on whether a task before ended in that digest, so every task puts out its last one too.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["w", "doc_id", "text_key", "a", "b", "first_id"]
        first_w, w, least_id, last_id = None, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            ws, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            first_w = ws[0] if first_w is None else first_w
            begin = runs(ws)
            first = ids[begin[:-1]].copy()
            if w == ws[0]:
                first[0] = least_id
            firsts = np.repeat(first, np.diff(begin))
            w, least_id, last_id = ws[-1], first[-1], ids[-1]
            known = ids > firsts
            whole = pa.record_batch([*batch.columns, pa.array(firsts, mask=~known)], names)
            yield whole.filter(pa.array(known | (ws == first_w)))
        if first_w is not None:
            yield pa.record_batch([pa.array([x], t) for x, t in zip((w, least_id, None, None, None, least_id), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))], names)

    key = ("w", "doc_id")
    dealt = windows.select("w", "doc_id", "text_key", "a", "b").repartitionByRange(*key).sortWithinPartitions(*key)
    found = written(dealt.transform(mapped, work, "w long, doc_id long, text_key long, a int, b int, first_id long"), "seen")
    ends = found.where("a IS NULL").groupBy(F.col("w").alias("of")).agg(F.min("first_id").alias("end_id"))
    unsure = found.where("a IS NOT NULL AND first_id IS NULL").drop("first_id")
    unsure = unsure.join(ends, (F.col("w") == F.col("of")) & (F.col("end_id") < F.col("doc_id")))
    sure = found.where("a IS NOT NULL AND first_id IS NOT NULL")
    return sure.select("doc_id", "text_key", "a", "b", "first_id").union(unsure.select("doc_id", "text_key", "a", "b", "end_id"))


def passages(df: DataFrame, id: str, text: str, least: int) -> DataFrame:
    """``doc_id, text_key, start, size, first_ids`` of every passage."""
    rows, path = written_at(split(df, id, text, least), "chunks")
    shared = written(holders(rows), "shared")
    removed(df.sparkSession, path)  # the largest table, and read no more
    found = written(look_ups(df, shared, id, text, least), "windows")
    again = found.where("w IS NULL").select("doc_id", "text_key", "a", "b", "first_id").union(later(found.where("w IS NOT NULL")))
    per_doc = again.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.struct("a", "b", "first_id"))).alias("c"))

    def join_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, name, c in zip(*(batch.column(k) for k in range(3))):
                a, b, first = (c.values.field(k).to_numpy() for k in ("a", "b", "first_id"))
                b = np.maximum.accumulate(b)
                begin = np.flatnonzero(np.append(True, a[1:] >= b[:-1]))
                for i, j in zip(begin, [*begin[1:], len(a)]):
                    rows.append((key.as_py(), name.as_py(), int(a[i]), int(b[j - 1] - a[i]), np.unique(first[i:j]).tolist()))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, kinds)], ["doc_id", "text_key", "start", "size", "first_ids"])

    return per_doc.transform(mapped, join_windows, "doc_id long, text_key long, start long, size long, first_ids array<long>")


def repeats(df: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """Passages of ``least`` words and more that an earlier document has too: ``doc_id, start, size, first_ids``.

    ``start`` and ``size`` are in bytes, from the first word to the last; ``first_ids`` are earlier documents
    that have parts of the passage, together all of it.  Null and empty texts, and rows without an id, have no passages.  Of
    rows that repeat an id none counts as earlier than another; rows equal in id and text have their passages once.
    """
    return passages(df, id, text, least).drop("text_key")


def without_spans(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """A text without the byte spans ``(start, size)``."""
    if not text or not spans:
        return text
    data, out, at = text.encode(), [], 0
    for start, size in sorted(spans):
        end = start + size
        if start >= at:
            out.append(data[at:start])
            at = max(at, end)
    return b"".join([*out, data[at:]]).decode("utf-8", "ignore")


def drop_repeats(df: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """``df`` with the repeated passages taken out of its text; every row and column stays.

    The first document that has a passage keeps it.  A row whose whole text repeats keeps an empty text.
    Texts move once, to the spans of their row, by the same join at every size.
    """
    spans = passages(df, id, text, least).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    spans = written(spans.select(F.col("doc_id").alias("__of"), F.col("text_key").alias("__key"), F.col("spans").alias("__spans")), "spans")
    joined = df.join(spans.hint("merge"), (F.col(id).cast("long") == F.col("__of")) & (F.xxhash64(F.col(text).cast("string")) == F.col("__key")), "left")

    names = df.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, texts = batch.column("__spans").to_pylist(), batch.column(text)
            if any(lists):
                texts = [without_spans(t, [(s["start"], s["size"]) for s in spans or []]) for t, spans in zip(texts.to_pylist(), lists)]
            data = {name: batch.column(name) for name in names} | {text: pa.array(texts, pa.string()) if isinstance(texts, list) else texts}
            yield pa.record_batch(list(data.values()), list(data))

    return joined.select(*names, "__spans").transform(mapped, cut, df.schema)

