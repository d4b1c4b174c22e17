"""Vector search in tiles: every query against every tile of rows, per-query lists merged as a tree.

A tile has a bounded number of bytes and holds rows dealt by a hash of their id, so clusters and
copies spread over all tiles.  Queries are sent to every tile and stream through its task in batches, after
the tile's rows; nothing but the tile is held.  Each tile gives the best rows of each query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from logframe.llm.common import mapped

#: Bytes of a tile's rows as double precision numbers.
TILE_BYTES = 96 << 20
#: Lists that are merged at once.
FAN_IN = 16

Lists = list[tuple[np.ndarray, np.ndarray]]


def usable(vector: Column, zero: bool) -> Column:
    """Whether a vector is there, not empty, all finite, and, unless ``zero``, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vector.isNotNull() & (F.size(vector) > 0) & ~bad
    return good if zero else good & F.exists(vector, lambda x: x != 0)


def matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors of a column by their length: row numbers and matrix."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy()
    sizes = np.diff(offsets)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[offsets[rows][:, None] + np.arange(size)]


def best(ids: np.ndarray, order: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` rows of smallest ``order``, ties to the smaller id."""
    top = np.lexsort((ids, order))[:k]
    return ids[top], scores[top]


def search(
    df: DataFrame, id: str, vector: str, every: int, k: int, zero: bool, kind: str, largest: bool,
    build: Callable[[np.ndarray, np.ndarray], object], find: Callable[[object, np.ndarray, np.ndarray, int], Lists],
) -> DataFrame:
    """``query_id, rank, vec_id, score`` (of SQL type ``kind``): the ``k`` best rows of each query.

    Queries are the rows whose id is divisible by ``every``.  ``build(ids, matrix)`` makes a tile's index
    and ``find(index, query ids, query matrix, k)`` gives each query's best ids and scores in it, without
    rows of the query's own id.  Vectors are compared with those of the same length.  Rows equal in id and vector
    are one; rows of one id with different vectors are all candidates, and as queries they are asked together.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v") if "array<float>" != dict(df.dtypes)[vector] else F.col(vector).alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v"), zero))
    extent = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    per_tile = max(1024, TILE_BYTES // (8 * (extent.dim or 1)))
    tiles = max(spark.sparkContext.defaultParallelism, -(-extent.n // per_tile))

    of_tile = F.pmod(F.xxhash64("vec_id"), F.lit(tiles)).cast("int")
    data = rows.select(of_tile.alias("tile"), F.lit(0).alias("side"), "vec_id", "v")
    asked = rows.where(F.col("vec_id") % every == 0)
    asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"), F.lit(1).alias("side"), "vec_id", "v")
    dealt = data.union(asked).repartition(tiles, "tile").sortWithinPartitions("tile", "side", "vec_id", "v")

    out_kind = pa.int64() if kind == "long" else pa.float64()
    item = pa.struct([("score", out_kind), ("vec_id", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, index, last = None, [], None, None
        for batch in batches:
            tile_of, side = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero((np.diff(tile_of) != 0) | (np.diff(side) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(side)] if len(side) else []):
                part = batch.slice(a, b - a)
                if tile_of[a] != tile:
                    tile, held, index, last = tile_of[a], [], None, None
                if side[a] == 0:
                    fresh, last = unlike(part, last)
                    held.append(part.filter(pa.array(fresh)))
                    continue
                if index is None:
                    index, held, last = indexed(held, build), [], None
                fresh, last = unlike(part, last)
                part = part.filter(pa.array(fresh))
                keys, found = [], []
                for rows, m in matrices(part.column(3)):
                    own = part.column(2).to_numpy()[rows]
                    if m.shape[1] in index:
                        for q, (v, s) in zip(own.tolist(), find(index[m.shape[1]], own, m, k)):
                            keys.append(q)
                            found.append([{"score": y, "vec_id": x} for x, y in zip(v.tolist(), s.tolist())])
                yield pa.record_batch([pa.array(keys, pa.int64()), pa.array([int(tile)] * len(keys), pa.int32()), pa.array(found, pa.list_(item))], ["query_id", "part", "top"])

    lists = dealt.transform(mapped, scan, f"query_id long, part int, top array<struct<score:{kind},vec_id:long>>")
    while True:
        merged = F.array_sort(F.flatten(F.collect_list("top")), lambda a, b: _order(a, b, largest))
        last_level = tiles <= FAN_IN
        group = F.lit(0) if last_level else F.floor(F.col("part") / FAN_IN).cast("int")
        lists = lists.groupBy("query_id", group.alias("part")).agg(F.slice(merged, 1, k).alias("top"))
        if last_level:
            break
        tiles = -(-tiles // FAN_IN)
    ranked = lists.select("query_id", F.posexplode("top").alias("at", "t"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "t.vec_id", "t.score")


def unlike(part: pa.RecordBatch, last: tuple | None) -> tuple[np.ndarray, tuple]:
    """Which rows of a sorted part differ from the row before in id or vector, and its last row."""
    ids, vectors = part.column(2).to_numpy(), part.column(3)
    fresh = np.append(True, ids[1:] != ids[:-1])
    fresh[0] = last is None or last[0] != ids[0] or last[1] != vectors[0].as_py()
    for i in np.flatnonzero(~fresh[1:]) + 1:  # rows that repeat an id
        fresh[i] = vectors[int(i)].as_py() != vectors[int(i) - 1].as_py()
    return fresh, (ids[-1], vectors[-1].as_py())


def indexed(held: list[pa.RecordBatch], build) -> dict[int, object]:
    """A tile's index by vector length."""
    parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in held:
        ids = batch.column(2).to_numpy()
        for rows, m in matrices(batch.column(3)):
            parts.setdefault(m.shape[1], []).append((ids[rows], m))
    return {size: build(np.concatenate([i for i, _ in p]), np.concatenate([m for _, m in p])) for size, p in parts.items()}


def _order(a: Column, b: Column, largest: bool) -> Column:
    better = a["score"] > b["score"] if largest else a["score"] < b["score"]
    same = a["score"] == b["score"]
    first = better | (same & (a["vec_id"] < b["vec_id"]))
    return F.when(first, -1).when(same & (a["vec_id"] == b["vec_id"]), 0).otherwise(1)
