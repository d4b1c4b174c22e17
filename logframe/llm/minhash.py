"""Near-duplicates by MinHash: one permutation, optimal densification, banded buckets, star-shaped candidates.

A set of shingles is hashed once, the hash space is split into ``BINS`` bins and the least hash of
each bin is its value; an empty bin takes the value of the first filled bin on a random walk of its own, the
same for every set, so that a bin of two sets agrees with the probability of their similarity.  ``ROWS`` bins form the key of
a bucket in each of ``BANDS`` bands.  At a similarity of 0.8 a pair shares no bucket once in 300,000 pairs.

Rows of a bucket are never paired with each other but with centres: a first one, and in every
further round sixteen times as many among the rows left, of different components; from the fourth round on several of one.  Two sketches tell how similar a row
and a centre are nearly, and those that are plainly apart form no pair: the parities of the hashes in ``PARITIES`` classes,
which never differ in more places than the sets do and tell most of sets of hundreds, and one bit of every bin,
which tells most of larger ones.  One pair in a million at the bound is taken for apart.  A pair counts only after the full sets were compared.  A centre has then met its whole bucket and leaves it, and a
bucket whose rows are one component is done, so whatever could still change the result is compared and copies never are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import count
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from logframe.llm.common import LOWER_ASCII, mapped, text_rows, written
from logframe.llm.components import connected
from logframe.llm.simhash import SEED

BANDS, ROWS, BINS = 24, 4, 512
PARITIES = 1024
#: Standard deviations that a sketch may be off.
DEVIATIONS = 5.5
#: Each further round has so many times the centres.
MORE = 16

_drawn = np.random.default_rng(11)
#: The walk of every bin over all bins, and where on it each bin comes.
WALKS = np.array([_drawn.permutation(BINS) for _ in range(BINS)])
PLACES = WALKS.argsort(1)
#: The least hash of every bin.
EDGES = np.array([(b << 64) // BINS for b in range(BINS)], np.uint64)
#: Odd, so that no hash of a word is lost.
PLACE = np.uint64(0x9E3779B97F4A7C15)
#: Hashes of words that a Python worker keeps.
MOST_WORDS = 1 << 19
FACTORS = _drawn.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    """The hashes of words, each computed when it is first met."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, SEED)
        return found


_words = WordHashes()


def hashes(text: str | None, words: int) -> np.ndarray:
    """The hashes of a text's shingles of lower-cased words in order, repeats included; fewer words are one shingle.

    A shingle's hash is made of those of its words and their places, so that every word is hashed once.
    """
    tokens = text.encode().translate(LOWER_ASCII).split() if text else []  # at the six ASCII blanks alone
    if not tokens:
        return np.zeros(0, np.uint64)
    of_words = np.fromiter(map(_words.__getitem__, tokens), np.uint64, len(tokens))
    size = min(words, len(tokens))
    last = len(tokens) - size + 1
    h = np.full(last, size, np.uint64)
    for k in range(size):
        h = (h + of_words[k : k + last]) * PLACE
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def signature(own: np.ndarray) -> np.ndarray:
    """The value of every bin for a set of sorted distinct hashes, which is not empty."""
    at = np.searchsorted(own, EDGES)
    filled = at < np.append(at[1:], len(own))
    have, empty = np.flatnonzero(filled), np.flatnonzero(~filled)
    donor = np.arange(BINS)
    if len(have) <= BINS // 4:
        donor[empty] = have[PLACES[np.ix_(empty, have)].argmin(1)]
    else:
        step = 0
        while len(empty):
            donor[empty] = WALKS[empty, step]
            empty, step = empty[~filled[donor[empty]]], step + 1
    return own[at[donor]]


def bucket_keys(values: np.ndarray) -> np.ndarray:
    """The bucket of every band."""
    return (values[: BANDS * ROWS].reshape(BANDS, ROWS) * FACTORS).sum(1).view(np.int64)


def sketch(values: np.ndarray) -> np.ndarray:
    """One bit of every bin, as signed 64-bit numbers."""
    return np.packbits((values & np.uint64(1)).astype(bool)).view(np.int64)


def parities(own: np.ndarray) -> np.ndarray:
    """Whether the number of hashes of each class is odd, as signed 64-bit numbers."""
    odd = np.bincount((own >> np.uint64(20) & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def most_apart(percent: int) -> int:
    """Bits that two sketches at the bound differ in, and some standard deviations more."""
    p = (1 - percent / 100) / 2
    return int(BINS * p + DEVIATIONS * (BINS * p * (1 - p)) ** 0.5) + 1


def most_odd(sizes: Column, percent: int) -> Column:
    """Parities that two sets of together so many hashes can differ in at the bound.

    They differ in at most so many hashes; as many balls thrown into the classes leave so many odd, give or take some deviations.
    """
    m = PARITIES
    apart = F.floor(sizes * (100 - percent) / (100 + percent))
    one, two = F.pow(F.lit(1 - 2 / m), apart), F.pow(F.lit(1 - 4 / m), apart)
    variance = F.greatest(m / 4 * (1 - one * one) + m * (m - 1) / 4 * (two - one * one), F.lit(0.0))
    return F.least(apart, m / 2 * (1 - one) + DEVIATIONS * F.sqrt(variance) + 1)


def apart(a: str, b: str, bits: int) -> Column:
    """Differing bits of two sketches."""
    return reduce(add, (F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(bits // 64)))


def profiles(df: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """``doc_id, n, key, fp, hs, sketch, odd``: the size of every row's set, its digest, the text's SimHash, its buckets and sketches."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_rows(batches):
            sizes, keys, prints, buckets, bits, odd = [], [], [], [], [], []
            for value in texts:
                every = hashes(value, words)
                ones = sum(np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64) for part in np.split(every, range(1 << 16, len(every), 1 << 16)))
                prints.append(np.packbits(2 * ones > len(every), bitorder="little").view("<i8")[0])
                own = np.unique(every)
                sizes.append(len(own))
                keys.append(xxhash.xxh3_128_digest(own.tobytes()))
                values = signature(own) if len(own) else None
                buckets.append(None if values is None else bucket_keys(values))
                bits.append(None if values is None else sketch(values))
                odd.append(parities(own))
            longs = pa.list_(pa.int64())
            columns = [pa.array(c, t) for c, t in zip((ids, sizes, keys, prints, buckets, bits, odd), (pa.int64(), pa.int64(), pa.binary(), pa.int64(), longs, longs, longs))]
            yield pa.record_batch(columns, ["doc_id", "n", "key", "fp", "hs", "sketch", "odd"])

    rows = df.select(F.col(id).cast("long"), F.col(text).cast("string"))
    return rows.transform(mapped, compute, "doc_id long, n long, key binary, fp long, hs array<long>, sketch array<long>, odd array<long>")


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` whose full sets have the similarity; ``texts(node, t)`` holds their texts.

    Pairs come sorted by ``a``, so the set of a centre is formed once per task.
    """
    right = texts.select(F.col("node").alias("b"), F.col("t").alias("tb"))
    left = texts.select(F.col("node").alias("a"), F.col("t").alias("ta"))
    joined = pairs.join(right, "b").hint("merge").join(left, "a").select("a", "b", "ta", "tb")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            keep = []
            for a, s, t in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if (a, s) != last:
                    last, own = (a, s), np.unique(hashes(s.as_py(), words))
                other = np.unique(hashes(t.as_py(), words))
                both = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(own) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.transform(mapped, compare, "a long, b long").distinct()


def crowded(nodes: DataFrame) -> DataFrame:
    """``h, node, n`` of the buckets with several nodes, of buckets with the same nodes only one."""
    rows = nodes.select(F.explode("hs").alias("h"), "node", "n").distinct()
    members = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"of{k}") for k in range(2)]
    one = rows.groupBy("h").agg(F.count("*").alias("many"), *members).where("many > 1")
    one = one.groupBy("many", "of0", "of1").agg(F.min("h").alias("h"))
    return rows.join(one.select("h"), "h", "left_semi")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows(node, ...)`` with the component of every node, itself if it has no link."""
    known = labels.select(F.col("node").alias("of"), F.col("label").alias("known"))
    return rows.join(known, F.col("node") == F.col("of"), "left").withColumn("label", F.coalesce("known", "node")).drop("of", "known")


def components(nodes: DataFrame, texts: DataFrame, words: int, percent: int, links: DataFrame, close: DataFrame | None = None) -> DataFrame:
    """``node, label``: the component of every node of ``nodes(node, n, hs, sketch, odd)`` that is linked.

    ``texts(node, t)`` are the texts of the table, ``links(a, b)`` hold anyway, ``close(a, b)`` are further candidates.
    """
    found = crowded(nodes)
    rows = written(found.join(nodes.select("node", "sketch", "odd"), "node"), "buckets")
    wanted = rows.select(F.col("node").alias("of"))
    if close is not None:
        wanted = wanted.union(close.select("a")).union(close.select("b"))
    known = written(texts.join(wanted.distinct(), texts.node == F.col("of"), "left_semi"), "texts")
    tested = close
    if close is not None:
        links = links.union(written(verified(close, known, words, percent), "links"))
    labels = connected(links)
    near = (100 * F.least("n", "size") >= percent * F.greatest("n", "size")) & (apart("sketch", "bits", BINS) <= most_apart(percent))
    near = near & (apart("odd", "parity", PARITIES) <= most_odd(F.col("n") + F.col("size"), percent))
    bucket = Window.partitionBy("h")
    for turn in count():
        rows = written(labelled(rows.select("h", "node", "n", "sketch", "odd"), labels), "rows")
        # One of a component at first, as the first link of a row spares it the others; then more, for large components that stay apart.
        slot = F.struct(F.pmod(F.xxhash64("label", F.lit(turn)), F.lit(MORE ** min(turn, 12))), F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(4 ** min(max(turn - 2, 0), 24))))
        chosen = rows.groupBy("h", slot.alias("slot")).agg(F.min("node").alias("centre"), F.min("label").alias("low"), F.max("label").alias("high"))
        chosen = chosen.withColumn("mixed", F.min("low").over(bucket) < F.max("high").over(bucket)).where("mixed")
        chosen = rows.join(chosen.select("h", F.col("centre").alias("node")), ["h", "node"])
        chosen = written(chosen.select("h", F.col("node").alias("centre"), F.col("n").alias("size"), F.col("sketch").alias("bits"), F.col("odd").alias("parity"), F.col("label").alias("own")), "centres")
        if chosen.isEmpty():
            return labels
        pairs = rows.join(chosen, "h").where(near & (F.col("label") != F.col("own")))
        pairs = pairs.select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        found = written(verified(pairs, known, words, percent), "links")
        if not found.isEmpty():
            links = links.union(found)
            labels = connected(links)
        rows = rows.join(chosen.select("h").distinct(), "h", "left_semi")
        rows = rows.join(chosen.select("h", F.col("centre").alias("node")), ["h", "node"], "left_anti")


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", words: int = 4, percent: int = 80) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_shingles, component_id, kept``.

    A row's set is that of its ``words``-word shingles, lower-cased; with fewer words all of them are the one shingle.
    Rows are linked if 100 times the intersection is at least ``percent`` times the union.  ``component_id`` is the
    smallest id reached, the row's own included, and ``kept`` says that it is the row's own.  A text that is null, empty or
    without words has an empty set and is linked with nothing.  Rows of equal sets are one node whatever their number;
    rows that share an id are one document and linked with what either is linked with.  A row without
    an id links nothing, has no component and is kept.  Only id and text are read; an empty table gives no rows.
    """
    rows = written(profiles(df, id, text, words).drop("fp"), "profiles")
    return resolved(rows, lambda nodes, links: components(nodes, texts_of(df, id, text), words, percent, links))


def texts_of(df: DataFrame, id: str, text: str) -> DataFrame:
    """``node, t`` of every row."""
    return df.select(F.col(id).cast("long").alias("node"), F.col(text).cast("string").alias("t"))


def resolved(rows: DataFrame, search: Callable[[DataFrame, DataFrame], DataFrame], blank: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of ``rows(doc_id, n, key, hs, sketch, odd)``; ``blank`` makes empty sets equal.

    ``search`` gives the components of the nodes, given those that share an id.  The node of a set is the
    smallest id that has it, so the least node of a component is its smallest id.
    """
    takes_part = F.col("doc_id").isNotNull() & ((F.col("n") > 0) | blank)
    named = rows.where(takes_part)
    first = written(named.groupBy("key").agg(F.min("doc_id").alias("node"), F.max("doc_id").alias("last")), "first")
    of = first.select(F.col("key").alias("k"), "node")
    nodes = named.join(of, (F.col("key") == F.col("k")) & (F.col("doc_id") == F.col("node"))).drop("k", "key", "doc_id")
    twice = named.groupBy("doc_id").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high").select("doc_id")
    shared = named.select("doc_id", "key").join(twice, "doc_id", "left_semi").join(of, F.col("key") == F.col("k")).select("doc_id", "node")
    links = shared.join(shared.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id").select("a", F.col("node").alias("b")).where("a <> b")
    labels = search(nodes, written(links.distinct(), "shared"))
    found = labelled(first, labels).where("last <> node OR label <> node").select(F.col("key").alias("k"), "label")
    found = written(found, "components")
    whole = rows.select("doc_id", "n", F.when(takes_part, F.col("key")).alias("key"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id")).alias("component_id")
    joined = whole.join(found, F.col("key") == F.col("k"), "left").select("doc_id", F.col("n").alias("n_shingles"), component)
    return joined.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
