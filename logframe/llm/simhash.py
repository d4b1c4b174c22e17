"""SimHash near-duplicates with BK-trees.

The trees hold the distinct fingerprints.  Two fingerprints within ``radius`` bits agree wholly in
at least ``blocks - radius`` of ``blocks`` bit blocks, so each is dealt to one shard per choice of
that many blocks, and shards that share nothing are never compared.  Every shard is a BK-tree:
children are keyed by their integer Hamming distance to the parent, and a search follows only the
edges within the radius.  A tree goes to the queries of its shard by the shuffle and not by a
driver broadcast, as the size of all trees has no bound.  A shard of more than ``SHARD``
fingerprints is cut into several trees, and the queries of that shard go to each of them.  Rows of such a
large shard within the radius of its smallest fingerprint are linked to that at once and
compared only with the rest.  A shard puts out a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from logframe.llm.common import LOWER_ASCII, mapped, runs, text_rows, whole_groups, written
from logframe.llm.components import connected

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SEED = 42
#: Most fingerprints of one tree.
SHARD = 4096
#: Most (query, node) pairs looked at together.
FRONTIER = 1 << 21


def shingles(text: str | None, words: int) -> list[memoryview]:
    """A text's shingles of ``words`` lower-cased words in order; a shorter text is one shingle."""
    tokens = WORD.findall(text.encode().translate(LOWER_ASCII)) if text else []
    if not tokens:
        return []
    joined = memoryview(b" ".join(tokens))
    ends = list(itertools.accumulate(len(t) + 1 for t in tokens))
    starts = [0, *ends[:-1]]
    last = max(len(tokens) - words + 1, 1)
    return [joined[a : b - 1] for a, b in zip(starts[:last], ends[min(words, len(tokens)) - 1 :])]


def fingerprint(text: str | None, words: int = 4) -> int:
    """The 64-bit SimHash of one text, over its shingles of ``words`` lower-cased words."""
    digest = xxhash.xxh64_intdigest
    hashes = [digest(s, SEED) for s in shingles(text, words)]
    last = len(hashes)
    if not last:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, last, 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > last, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id: str = "doc_id", text: str = "text", words: int = 4) -> DataFrame:
    """``doc_id, fp`` (long, the 64 bits as a signed number) of every row; null text has no words."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_rows(batches):
            found = np.array([fingerprint(t, words) for t in texts], "<u8").view("<i8")
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(found, pa.int64())], ["doc_id", "fp"])

    rows = df.select(F.col(id).cast("long"), F.col(text).cast("string"))
    return rows.transform(mapped, compute, "doc_id long, fp long")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits."""
    return np.bitwise_count(a ^ b).astype(np.int64)


class Forest:
    """One BK-tree of distinct values per group, in arrays; ``group`` is sorted."""

    def __init__(self, group: np.ndarray, value: np.ndarray) -> None:
        starts = runs(group)[:-1]
        self.value, self.groups, self.root = value, group[starts], starts
        parent = np.full(len(value), -1)
        edge = np.zeros(len(value), np.int64)
        at = np.repeat(starts, np.diff(np.append(starts, len(value))))
        waiting = np.setdiff1d(np.arange(len(value)), starts)
        at = at[waiting]
        while len(waiting):
            apart = distance(value[waiting], value[at])
            order = np.lexsort((apart, at))
            waiting, at, apart = waiting[order], at[order], apart[order]
            first = runs(at, apart)[:-1]
            child = waiting[first]
            parent[child], edge[child] = at[first], apart[first]
            into = np.repeat(child, np.diff(np.append(first, len(at))))
            rest = np.ones(len(at), bool)
            rest[first] = False
            waiting, at = waiting[rest], into[rest]
        self.child = np.lexsort((edge, parent))
        self.slot = parent[self.child] * 65 + edge[self.child]

    def within(self, query: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, tree row) at most ``radius`` apart, the trees level by level."""
        where = np.searchsorted(self.groups, group)
        q = np.arange(len(query))
        node = self.root[where]
        while len(q):
            apart = distance(query[q], self.value[node])
            near = apart <= radius
            yield q[near], node[near]
            low = np.searchsorted(self.slot, node * 65 + np.maximum(apart - radius, 1))
            high = np.searchsorted(self.slot, node * 65 + np.minimum(apart + radius, 64), "right")
            many = high - low
            q = np.repeat(q, many)
            node = self.child[np.arange(len(q)) + np.repeat(low - np.cumsum(many) + many, many)]


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the classes of ``a`` and ``b`` in ``label``, where each row names the first of its class."""
    while True:
        left, right = label[a], label[b]
        apart = left != right
        if not apart.any():
            return
        a, b, left, right = a[apart], b[apart], left[apart], right[apart]
        np.minimum.at(label, np.maximum(left, right), np.minimum(left, right))
        while not np.array_equal(label, over := label[label]):
            label[:] = over


def forest_links(unit: np.ndarray, value: np.ndarray, tree: np.ndarray, asks: np.ndarray, radius: int):
    """A spanning forest of the links between tree rows and asking rows of the same unit."""
    label = np.arange(len(unit))
    rows = np.flatnonzero(tree)
    if len(rows):
        forest = Forest(unit[rows], value[rows])
        size = np.diff(np.append(forest.root, len(rows)))
        ask = np.flatnonzero(asks)
        ask = ask[np.isin(unit[ask], forest.groups)]
        most = np.cumsum(size[np.searchsorted(forest.groups, unit[ask])])
        cuts = np.flatnonzero(np.diff(most // FRONTIER)) + 1
        for part in np.split(ask, cuts):
            for q, node in forest.within(value[part], unit[part], radius):
                join_labels(label, part[q], rows[node])
    linked = np.flatnonzero(label != np.arange(len(unit)))
    return label[linked], linked


def links(fps: DataFrame, radius: int = 4, blocks: int = 6, shard: int = SHARD) -> DataFrame:
    """Edges ``a, b`` that connect all fingerprints of ``fps(fp)`` (distinct) within ``radius`` bits."""
    if not radius < blocks <= 64:
        raise ValueError("more blocks than the radius are needed")
    edge = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = []
    for chosen in itertools.combinations(range(blocks), blocks - radius):
        mask = sum((1 << edge[i + 1]) - (1 << edge[i]) for i in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    dealt = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for c, m in enumerate(masks)])).alias("s")).select("s.c", "s.k", "fp")
    sizes = dealt.groupBy("c", "k").agg(F.count("*").alias("n"), F.min("fp").alias("pivot")).where("n > 1")
    dealt = dealt.join(sizes, ["c", "k"])
    core = (F.col("n") > shard) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("pivot"))) <= radius)
    parts = F.ceil(F.col("n") / shard).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)

    def unit(kind, i, j, tree, asks):
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), tree.alias("tree"), asks.alias("asks"))

    yes, no = F.lit(True), F.lit(False)
    among = F.transform(every, lambda j: unit(0, F.least("own", j), F.greatest("own", j), F.col("own") <= j, F.col("own") >= j))
    against = F.transform(every, lambda j: unit(1, F.col("own"), j, yes, no))
    asking = F.transform(every, lambda i: unit(1, i, F.col("own"), no, yes))
    dealt = dealt.withColumn("core", core).withColumn("parts", parts).withColumn("own", own)
    units = dealt.withColumn(
        "u",
        F.explode(
            F.when(F.col("core"), asking)
            .when(F.col("n") > shard, F.concat(among, against))
            .otherwise(F.array(unit(0, F.lit(0), F.lit(0), yes, yes)))
        ),
    ).select("c", "k", "u.kind", "u.i", "u.j", "fp", "u.tree", "u.asks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data in whole_groups(batches, 5):
            keys = [data.column(i).to_numpy() for i in range(5)]
            starts = runs(*keys)
            unit = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            value = data.column(5).to_numpy().astype(np.int64)
            tree, asks = (data.column(i).to_numpy() for i in (6, 7))
            a, b = forest_links(unit, value.view(np.uint64), tree, asks, radius)
            yield pa.record_batch([pa.array(value[a]), pa.array(value[b])], ["a", "b"])

    key = ["c", "k", "kind", "i", "j"]
    found = units.repartition(*key).sortWithinPartitions(*key).transform(mapped, search, "a long, b long")
    near = dealt.where("core and fp <> pivot").select(F.col("pivot").alias("a"), F.col("fp").alias("b"))
    return found.union(near)


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4) -> DataFrame:
    """One row per row of ``df``: ``doc_id, fp, component_id``.

    ``component_id`` is the smallest id among the rows reached by links of at most ``radius``
    differing bits.  Equal fingerprints are one node, whatever the number of copies.  A text that is
    null, empty or without words has fingerprint zero and is linked like any other.  Rows without an
    id take part and get the id of their component; repeated rows are repeated.  No other column of
    ``df`` is read.
    """
    docs = written(fingerprints(df, id, text, words), "fingerprints")
    nodes = written(docs.groupBy("fp").agg(F.min("doc_id").alias("root")), "nodes")
    labels = connected(links(nodes.select("fp"), radius))
    grouped = nodes.join(labels, nodes.fp == labels.node, "left").select("fp", "root", F.coalesce("label", "fp").alias("label"))
    least = grouped.groupBy("label").agg(F.min("root").alias("component_id"))
    found = written(grouped.join(least, "label").select(F.col("fp").alias("of"), "component_id"), "components")
    return docs.join(found, docs.fp == found.of).select("doc_id", "fp", "component_id")
