"""Exact top-k by inner product of vectors scaled to integers, as tiled matrix products.

The product of a block of queries with a slice of a tile is one matrix product; a partial selection
keeps each query's best of the slice, and slices, then tiles, are merged.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame

from logframe.llm.vectors import Lists, best, search

SCALE = 1024
#: Queries and rows of one matrix product.
QUERIES, ROWS = 256, 16384
LIMIT = (1 << 63) - 1


class Tile:
    """Rows as whole numbers, in order of their ids."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.raw = ids[order], rows[order]
        self.rows = whole(self.raw)
        self.most = float(np.abs(self.rows).max(initial=0))
        #: Rows that share an id, at most.
        self.copies = int(np.unique(self.ids, return_counts=True)[1].max(initial=1))


def whole(rows: np.ndarray) -> np.ndarray:
    """Components times ``SCALE``, rounded down, still as double precision numbers; infinite where these end."""
    with np.errstate(over="ignore"):
        return np.floor(rows.astype(np.float64) * SCALE)


def exact(rows: np.ndarray) -> np.ndarray:
    """Components times ``SCALE``, rounded down, as Python's integers."""
    return np.array([[int(x) * SCALE if abs(x) >= 1 << 53 else math.floor(x * SCALE) for x in r] for r in rows.astype(np.float64).tolist()], object)


def products(tile: np.ndarray, queries: np.ndarray, bound: float) -> np.ndarray:
    """Inner products of raw vectors, exact: in double precision while sums stay below 2^53, else in Python's integers."""
    if bound < 1 << 53:
        return whole(queries) @ whole(tile).T
    return np.array([[max(-LIMIT - 1, min(LIMIT, x)) for x in r] for r in exact(queries) @ exact(tile).T], np.int64)


def find(tile: Tile, own: np.ndarray, queries: np.ndarray, k: int) -> Lists:
    """The rows of largest product for each query."""
    found: Lists = []
    for first in range(0, len(own), QUERIES):
        block = queries[first : first + QUERIES]
        scaled = whole(block)
        bound = tile.most * float(np.abs(scaled).max(initial=0)) * max(block.shape[1], 1)
        bound = bound if bound == bound else float("inf")  # nothing times infinitely much
        tops: Lists = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(block)
        for at in range(0, len(tile.ids), ROWS):
            ids = tile.ids[at : at + ROWS]
            part = slice(at, at + ROWS)
            scores = (scaled @ tile.rows[part].T).astype(np.int64) if bound < 1 << 53 else products(tile.raw[part], block, bound)
            for i, key in enumerate(own[first : first + QUERIES]):
                rows = selected(scores[i], k + tile.copies)  # more, as rows of the query's own id may be among them
                rows = rows[ids[rows] != key]
                ids_, scores_ = np.append(tops[i][0], ids[rows]), np.append(tops[i][1], scores[i][rows])
                tops[i] = best(ids_, ~scores_, scores_, k)
        found += tops
    return found


def selected(scores: np.ndarray, k: int) -> np.ndarray:
    """The rows of the ``k`` largest scores, of equal ones those that come first."""
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    return np.append(above, np.flatnonzero(scores == least)[: k - len(above)])


def top_products(df: DataFrame, id: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score`` (long): the ``k`` largest products for each row whose id is divisible by ``every``.

    Components are floor(1024 * x).  Ties go to the smaller id; the query's own row is left out.  Rows
    without an id and vectors that are null, empty, or hold null or non-finite components take no part;
    zero vectors do.  Rows equal in id and vector are one; rows of one id with different vectors are all
    candidates, and as queries they are asked together.
    Products beyond 64 bits count as the nearest 64-bit number.  Fewer than ``k`` other rows give fewer
    results, and an empty table none.
    """
    return search(df, id, vector, every, k, True, "long", True, Tile, find)
