"""The text index of a log table at rest: which trigrams of bytes the lines of every file hold.

A Bloom filter per file (one per read task of a file) in blocks of ``BLOCK`` bytes, sorted by block, in the folder ``_grams`` of
the table: looking a text up reads the few blocks that its trigrams fall into.  A scan for a literal then reads only
the files all of whose trigrams may be there.  Rows belong to a file and its size; files that the index does not know are
read, so a stale index loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from operator import and_, or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logframe.functions import regex
from logframe.functions.lines import LineFilter
from logframe.model import LINE
from logframe.sources.files import TEXT_INDEX, exists, table_files
from logframe.sources.tables import stored_schema

#: Bits of a filter: 512 KB before compression, for a file of some 100 MB.
BITS = 22
#: Bytes of a filter that are stored together; those without a bit are left out.
BLOCK = 4096
#: The block that every known file has, if only to say so.
KNOWN = -1
SCHEMA = "file string, size bigint, block int, grams binary"


def text_index_path(path: str) -> str:
    return f"{path.rstrip('/')}/{TEXT_INDEX}"


def places(data: np.ndarray) -> np.ndarray:
    """The bits of the trigrams of some bytes."""
    wide = data.astype(np.uint32)
    grams = wide[:-2] << np.uint32(16) | wide[1:-1] << np.uint32(8) | wide[2:]
    return grams * np.uint32(2654435761) >> np.uint32(32 - BITS)


def gram_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One filter per run of rows of one file; the lines of a batch are looked at together."""
    file, size, bits = None, None, None

    def whole() -> pa.RecordBatch:
        blocks = np.packbits(bits).reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(1))
        grams = [b"", *(blocks[k].tobytes() for k in used)]
        return pa.record_batch([pa.array([file] * len(grams)), pa.array([size] * len(grams), pa.int64()), pa.array([KNOWN, *used.tolist()], pa.int32()), pa.array(grams, pa.binary())], ["file", "size", "block", "grams"])

    for batch in batches:
        names, sizes, lines = (batch.column(k) for k in range(3))
        edges = [0, *(np.flatnonzero(np.diff(np.asarray(names.dictionary_encode().indices))) + 1).tolist(), len(names)] if len(names) else [0]
        for a, b in zip(edges, edges[1:]):
            name = names[a].as_py()
            if name != file:
                if file is not None:
                    yield whole()
                file, size, bits = name, sizes[a].as_py(), np.zeros(1 << BITS, bool)
            part = lines.slice(a, b - a).cast(pa.large_string())
            ends = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
            data = np.frombuffer(part.buffers()[2], np.uint8)[ends[0] : ends[-1]] if part.buffers()[2] is not None else np.zeros(0, np.uint8)
            if len(data) < 3:
                continue
            inside = np.ones(len(data), bool)  # no trigram reaches into the next line
            border = ends[1:] - ends[0]
            for back in (1, 2):
                at = border - back
                inside[at[at >= 0]] = False
            bits[places(data)[inside[:-2]]] = True
    if file is not None:
        yield whole()


def refresh_text_index(spark: SparkSession, path: str, *, column: str = LINE) -> int:
    """Add the filters of the files that the index does not know, and say how many these were."""
    known = table_files(spark, path).select("file", "size")
    if exists(spark, text_index_path(path)):
        known = known.join(spark.read.schema(SCHEMA).parquet(text_index_path(path)).select("file", "size").distinct(), ["file", "size"], "left_anti")
    found = sorted(r.file for r in known.select("file").collect())
    if found:
        df = spark.read.schema(stored_schema(spark, path)).option("basePath", path).parquet(*found)
        rows = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.coalesce(F.col(column), F.lit("")).alias("line"))
        filters = rows.mapInArrow(gram_filters, SCHEMA).sortWithinPartitions("block")
        filters.write.mode("append").option("parquet.block.size", 16 << 20).parquet(text_index_path(path))
    return len(found)


def literals_of(line_filters: Iterable[LineFilter]) -> list[str]:
    """Texts that every line that passes the filters holds."""
    found = []
    for op, value in line_filters:
        literal = regex.required_literal(value) if op == "regex" else value if op in ("contains", "prefix", "suffix") else ""
        if len(literal.encode()) >= 3:
            found.append(literal)
    return found


def _asked(literals: Iterable[str]) -> dict[int, list[int]]:
    """The bits of all trigrams of some texts, by block."""
    found: dict[int, list[int]] = {}
    for literal in literals:
        for at in np.unique(places(np.frombuffer(literal.encode(), np.uint8))).tolist():
            found.setdefault(at // (8 * BLOCK), []).append(at % (8 * BLOCK))
    return found


def _has(bits: list[int]) -> Column:
    """Whether a block has some bits."""
    byte = lambda at: F.conv(F.hex(F.substring("grams", at // 8 + 1, 1)), 16, 10).cast("int")
    return reduce(and_, (byte(at).bitwiseAND(F.lit(128 >> at % 8)) != 0 for at in bits))


def files_with(spark: SparkSession, path: str, literals: Iterable[str]) -> list[str] | None:
    """The files of a table that may hold lines with all the texts; ``None`` if that leaves none out."""
    literals = [text for text in literals if len(text.encode()) >= 3]
    if not literals or not exists(spark, text_index_path(path)):
        return None
    asked = _asked(literals)
    rows = spark.read.schema(SCHEMA).parquet(text_index_path(path)).where(F.col("block").isin([KNOWN, *asked]))
    hit = reduce(or_, ((F.col("block") == block) & _has(bits) for block, bits in asked.items()))
    # A line lies in one part of a file, so the blocks of that part all have their bits.
    hits = rows.groupBy("file", "size").agg(F.countDistinct(F.when(hit, F.col("block"))).alias("hits"))
    without = hits.where(F.col("hits") < len(asked)).select("file", "size")
    files = table_files(spark, path).select("file", "size")
    kept = sorted(r.file for r in files.join(without, ["file", "size"], "left_anti").select("file").collect())
    return None if len(kept) == files.count() else kept
