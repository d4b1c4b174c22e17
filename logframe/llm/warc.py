"""WARC archives and a two-level capture index.

Every scan task writes one archive, each record a gzip member of its own.  The index holds one line per
capture, sorted by the reversed-host URL key and the capture's id.  A range of keys goes to one index
file: blocks of ``BLOCK`` lines, compressed one by one, then a sparse directory with the first key
of every block, then the directory's place.  The first keys of the files themselves are the upper
level, one row per index task.  A look-up is dealt to its file by a binary search over the files,
reads the directory of that file, finds the block by a binary search, and reads that block and the record as
byte ranges.

Files go to the folder that driver and executors share, under names of their own per task attempt; only the
names that the finished tasks hand on are ever read.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
import struct
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from logframe.llm.common import mapped, shared_path, written

#: Lines of a compressed index block.
BLOCK = 512
#: Lines of an index file; bytes of records, or captures, that one task looks up.
FILE_LINES, TASK_BYTES, TASK_LINES = 1 << 20, 256 << 20, 1 << 16
DATE = "2024-01-01T00:00:00Z"
#: At the end of an index file: where its directory begins, and the directory's bytes.
PLACE = "<QQ"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NOWHERE = "http://invalid/"


def url_key(url: Column) -> Column:
    """The sort key of a URL: host labels reversed, then path and query, lower case, without scheme,
    ``www.``, port, fragment, blanks and control characters; null and empty give ``-)``."""
    bare = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"[\x00-\x20]", "")
    bare = F.regexp_replace(bare, r"^[a-z][a-z0-9+.-]*://", "")
    bare = F.regexp_replace(bare, "#.*$", "")
    host = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*", 0), r"^www[0-9]*\.|:[0-9]*$", "")
    rest = F.regexp_extract(bare, "^[^/?]*(.*)$", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)
    return F.when(key == ")", "-)").otherwise(key)


def payload_digest(payload: bytes) -> str:
    """The bare base32 SHA-1 of a payload."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(key: int | None, url: str | None, payload: bytes, original: int | None) -> bytes:
    """One WARC record: a response, or a revisit of the capture ``original`` without the payload.

    The HTTP header has the payload's length in both, as a revisit repeats the original's header.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = re.sub(r"[\x00-\x20]", "", url or "") or NOWHERE
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if original is None else 'revisit'}",
        f"WARC-Record-ID: <urn:capture:{'' if key is None else key}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if original is not None:
        head += [f"WARC-Refers-To: <urn:capture:{original}>", f"WARC-Profile: {PROFILE}"]
        payload = b""
    block = http + payload
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """The fields of one record: its type, digest, the capture it refers to, payload length, payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError(f"the record of {fields['WARC-Target-URI']} does not fit its digest")
    found = re.fullmatch(r"<urn:capture:(-?\d+)>", fields.get("WARC-Refers-To", ""))
    return {"record_type": fields["WARC-Type"], "payload_digest": digest, "payload_bytes": length, "refers_to": int(found[1]) if found else None, "payload": payload}


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path there."""
    return fs.FileSystem.from_uri(path)


class Output:
    """A file of this task attempt, made when first written to."""

    def __init__(self, folder: str, suffix: str) -> None:
        self.path = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}{suffix}"
        self.at, self.file = 0, None

    def write(self, data: bytes) -> tuple[int, int]:
        """Append; the place of what was written."""
        if self.file is None:
            system, name = opened(self.path)
            system.create_dir(name.rpartition("/")[0], recursive=True)
            self.file = system.open_output_stream(name, compression=None)
        self.file.write(data)
        place = (self.at, len(data))
        self.at += len(data)
        return place

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Ranges:
    """Byte ranges of a few files kept open."""

    def __init__(self) -> None:
        self.files: OrderedDict[str, pa.NativeFile] = OrderedDict()

    def file(self, path: str) -> pa.NativeFile:
        if path not in self.files:
            if len(self.files) >= 32:
                self.files.popitem(last=False)[1].close()
            system, name = opened(path)
            self.files[path] = system.open_input_file(name)
        return self.files[path]

    def read(self, path: str, at: int, size: int) -> bytes:
        return self.file(path).read_at(size, at)


def revisits(df: DataFrame, id: str = "page_id", payload: str = "html", at_least: int = 0) -> DataFrame:
    """``page_id, refers_to``: the rows whose payload (of ``at_least`` bytes) a row with a larger id has too."""
    content = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    slim = df.select(F.col(id).cast("long").alias("page_id"), F.octet_length(content).alias("n"), F.sha2(content, 256).alias("digest"))
    slim = slim.where(F.col("n") >= at_least)
    last = slim.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("first")).where("first < refers_to")
    last = written(last.select(F.col("digest").alias("of"), "refers_to"), "payloads")
    found = slim.join(last, slim.digest == last.of).where("page_id < refers_to").select("page_id", "refers_to")
    return found.distinct()


def write_archives(df: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html", at_least: int = 0) -> DataFrame:
    """Write a record per row; ``page_id, key, file, at, size`` says where each lies.

    Of equal payloads of ``at_least`` bytes, the row with the largest id is the response and the others
    revisit it.  Null payloads are empty ones.  Rows without an id are responses; rows that repeat an
    id are written once each.
    """
    folder = shared_path(df.sparkSession, "archives")
    of = written(revisits(df, id, payload, at_least).select(F.col("page_id").alias("of"), "refers_to"), "revisits")
    rows = df.select(F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(payload).cast("string").alias("html"))
    rows = rows.join(of, rows.page_id == of.of, "left").select("page_id", "url", "html", "refers_to", url_key(F.col("url")).alias("key"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Output(folder, ".warc.gz")
        for batch in batches:
            places = []
            for key, url, html, original in zip(*(batch.column(i) for i in range(4))):
                text = html.as_py()
                data = record(key.as_py(), url.as_py(), text.encode() if text else b"", original.as_py())
                places.append(out.write(gzip.compress(data, 4, mtime=0)))
            at, size = zip(*places) if places else ((), ())
            columns = [batch.column(0), batch.column(4), pa.array([out.path] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(size, pa.int64())]
            yield pa.record_batch(columns, ["page_id", "key", "file", "at", "size"])
        out.close()

    return written(rows.transform(mapped, write, "page_id long, key string, file string, at long, size long"), "captures")


def tasks_for(df: DataFrame, load: Column, most: int) -> int:
    """Tasks for some load, one for every core at least: what index rows take themselves says little of it."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-(df.agg(load).first()[0] or 0) // most))


def write_index(captures: DataFrame) -> list[tuple[str, int, str]]:
    """Sort ``captures`` into index files; the upper level: first key and id, and path of every file, in order."""
    folder = shared_path(captures.sparkSession, "index")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Output(folder, ".cdx")
        lines: list[bytes] = []
        directory: list[bytes] = []
        first: list[tuple[str, int]] = []

        def block() -> None:
            at, size = out.write(zlib.compress(b"\n".join(lines), 6))
            directory.append(b"\t".join([*lines[0].split(b"\t")[:2], b"%d\t%d" % (at, size)]))
            lines.clear()

        for batch in batches:
            for key, page, file, at, size in zip(*(batch.column(c).to_pylist() for c in ("key", "page_id", "file", "at", "size"))):
                if not first:
                    first.append((key, page))
                lines.append(f"{key}\t{'' if page is None else page}\t{file}\t{at}\t{size}".encode())
                if len(lines) == BLOCK:
                    block()
        if lines:
            block()
        if first:
            out.write(struct.pack(PLACE, *out.write(zlib.compress(b"\n".join(directory), 6))))
            yield pa.record_batch([pa.array([first[0][0]]), pa.array([first[0][1]], pa.int64()), pa.array([out.path])], ["key", "page_id", "path"])
        out.close()

    ordered = captures.repartitionByRange(tasks_for(captures, F.count("*"), FILE_LINES), "key", "page_id").sortWithinPartitions("key", "page_id")
    files = written(ordered.transform(mapped, write, "key string, page_id long, path string"), "files")
    found = [(r.key, r.page_id, r.path) for r in files.collect()]  # one row per index task
    return sorted(found, key=lambda r: sort_key(r[0], r[1]))


def sort_key(key: str, page: int | None) -> tuple[bytes, int]:
    """The order of the index: bytes of the key, then ids, null first."""
    return key.encode(), -(1 << 63) if page is None else page


def look_up(files: list[tuple[str, int, str]], wanted: DataFrame) -> DataFrame:
    """Read the captures ``wanted(page_id, key)`` back through the index; a capture that is not there gives no row.

    With a column ``size``, the bytes of a capture's record, the work is dealt by bytes, else by captures.
    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to, payload``.
    """
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    sent = wanted.sparkSession.sparkContext.broadcast(files)  # one entry per index task
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = [sort_key(k, p) for k, p, _ in sent.value]
        ranges, held = Ranges(), OrderedDict()

        def directory(path: str) -> tuple[list, list]:
            if path not in held:
                if len(held) >= 16:
                    held.popitem(last=False)
                size = ranges.file(path).size()
                at, length = struct.unpack(PLACE, ranges.read(path, size - struct.calcsize(PLACE), struct.calcsize(PLACE)))
                rows = [line.split(b"\t") for line in zlib.decompress(ranges.read(path, at, length)).split(b"\n")]
                held[path] = [(k, int(p or -(1 << 63))) for k, p, _, _ in rows], [(int(a), int(n)) for _, _, a, n in rows]
            return held[path]

        last: tuple = ()
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for page, key in zip(batch.column("page_id").to_pylist(), batch.column("key").to_pylist()):
                asked = sort_key(key, page)
                lines, begin, end = [], 0, 0
                f = bisect.bisect_left(top, asked)
                for path in [sent.value[i][2] for i in range(max(f - 1, 0), len(top)) if i < f or top[i] == asked]:
                    keys, places = directory(path)
                    b = bisect.bisect_left(keys, asked)
                    for i in range(max(b - 1, 0), len(keys)):
                        if i >= b and keys[i] != asked:
                            break
                        if last[:2] != (path, i):
                            rows = [line.split(b"\t") for line in zlib.decompress(ranges.read(path, *places[i])).split(b"\n")]
                            last = (path, i, [(k, int(p or -(1 << 63))) for k, p, *_ in rows], rows)
                        begin, end = bisect.bisect_left(last[2], asked), bisect.bisect_right(last[2], asked)
                        lines += last[3][begin:end]
                for _, _, file, at, length in lines:
                    got = parsed(gzip.decompress(ranges.read(file.decode(), int(at), int(length))))
                    out.append((page, *(got[n] for n in names[1:])))
                    size += len(got["payload"])
                if size > 4 << 20:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                    out, size = [], 0
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    # neighbours in the index are asked for together; ids part the captures of a common URL
    tasks = tasks_for(wanted, F.sum("size"), TASK_BYTES) if "size" in wanted.columns else tasks_for(wanted, F.count("*"), TASK_LINES)
    dealt = wanted.select("page_id", "key").distinct().repartitionByRange(tasks, "key", "page_id").sortWithinPartitions("key", "page_id")
    return dealt.transform(mapped, read, schema)


