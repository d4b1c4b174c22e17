"""Approximate nearest neighbours with a forest of hash strings.

Every tree gives each vector a string of ``LETTERS`` letters; a letter is the axis, with its sign,
nearest to the vector after a random rotation.  A tree is the sorted array of its strings, kept as
numbers, in which a prefix is a range.  A query descends each tree to its longest matching prefix and
then ascends all trees together, one letter at a time, until ``SHARE`` of the tile's rows are
candidates; at the root that is every row.  Candidates are measured exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from logframe.llm.vectors import Lists, best, search

TREES = 52
LETTERS = 3
#: Least share of a tile's rows that a query looks at.
SHARE = 0.12
SEED = 11


class Forest:
    """The trees over some vectors."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.rows = ids, rows.astype(np.float64)
        dim = rows.shape[1]
        self.alphabet = 2 * dim
        drawn = np.random.default_rng(SEED)
        self.turns = [[np.linalg.qr(drawn.standard_normal((dim, dim)))[0] for _ in range(LETTERS)] for _ in range(TREES)]
        self.order, self.codes = [], []
        for tree in range(TREES):
            code = self.code(self.rows, tree)
            order = np.argsort(code, kind="stable")
            self.order.append(order)
            self.codes.append(code[order])

    def code(self, rows: np.ndarray, tree: int) -> np.ndarray:
        """The strings of vectors in one tree, as numbers."""
        code = np.zeros(len(rows), np.int64)
        for turn in self.turns[tree]:
            for at in range(0, len(rows), 8192):
                moved = rows[at : at + 8192] @ turn
                axis = np.abs(moved).argmax(1)
                sign = np.take_along_axis(moved, axis[:, None], 1)[:, 0] > 0
                code[at : at + 8192] = code[at : at + 8192] * self.alphabet + 2 * axis + sign
        return code

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each tree, prefix length and query, the range of matching strings."""
        low = np.zeros((TREES, LETTERS + 1, len(queries)), np.int64)
        high = np.zeros_like(low)
        for tree in range(TREES):
            code = self.code(queries, tree)
            for length in range(LETTERS + 1):
                rest = self.alphabet ** (LETTERS - length)
                first = code // rest * rest
                low[tree, length] = np.searchsorted(self.codes[tree], first)
                high[tree, length] = np.searchsorted(self.codes[tree], first + rest)
        return low, high

    def candidates(self, low: np.ndarray, high: np.ndarray, least: int) -> np.ndarray:
        """Rows that share the longest prefix with which at least ``least`` rows are found in any tree."""
        for length in range(LETTERS, 0, -1):
            if (high[:, length] - low[:, length]).sum() < least:
                continue
            seen = np.zeros(len(self.ids), bool)
            for tree in range(TREES):
                seen[self.order[tree][low[tree, length] : high[tree, length]]] = True
            if np.count_nonzero(seen) >= least:
                return np.flatnonzero(seen)
        return np.arange(len(self.ids))


def find(forest: Forest, own: np.ndarray, queries: np.ndarray, k: int) -> Lists:
    """The nearest rows of each query among its candidates."""
    queries = queries.astype(np.float64)
    low, high = forest.ranges(queries)
    least = min(len(forest.ids), max(int(np.ceil(SHARE * len(forest.ids))), 4 * k + 1))
    found = []
    for i, key in enumerate(own):
        rows = forest.candidates(low[:, :, i], high[:, :, i], least)
        rows = rows[forest.ids[rows] != key]
        apart = np.sqrt(np.square(forest.rows[rows] - queries[i]).sum(1))
        found.append(best(forest.ids[rows], apart, apart, k))
    return found


def neighbours(df: DataFrame, id: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each row whose id is divisible by ``every``.

    ``score`` is the Euclidean distance of the original vectors in double precision; ties go to the smaller
    id.  Every row is indexed.  Rows without an id and vectors that are null, empty, all zero, or hold null or
    non-finite components take no part.  Rows equal in id and vector are one; rows of one id with different
    vectors are all candidates, and as queries they are asked together.  Fewer than ``k`` other rows give fewer results, and an empty table none.
    """
    return search(df, id, vector, every, k, False, "double", False, Forest, find)
