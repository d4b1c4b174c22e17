"""Near-duplicates by SimHash, made whole: the Jaccard similarity of sets of word shingles is at least a bound.

SimHash links within a few bits are the first candidates and connect copies and groups of close copies.  The
fingerprints of edited copies differ in more bits, so MinHash buckets find what they miss.  Candidates of
either kind count only after the full sets were compared; pairs that are connected already are not looked at again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logframe.llm.common import written
from logframe.llm.minhash import components, profiles, resolved, texts_of
from logframe.llm.simhash import links as simhash_links


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, radius: int = 4) -> DataFrame:
    """One row per row of ``df``: ``doc_id, component_id``, the smallest id of the row's component.

    Rows are linked if their sets of ``words``-word shingles have a Jaccard similarity of ``percent`` or
    more.  Rows of equal sets are one node; texts without words are equal.  A row without an id has no component.
    """
    rows = written(profiles(df, id, text, words), "profiles")

    def search(nodes: DataFrame, known: DataFrame) -> DataFrame:
        first = written(nodes.groupBy("fp").agg(F.min("node").alias("rep")), "fingerprints")
        left = first.select(F.col("fp").alias("fa"), F.col("rep").alias("ra"))
        right = first.select(F.col("fp").alias("fb"), F.col("rep").alias("rb"))
        near = written(simhash_links(first.select("fp"), radius), "near")
        across = near.join(left, near.a == left.fa).join(right, near.b == right.fb).select("ra", "rb")
        alike = nodes.join(left, nodes.fp == left.fa).where("node <> ra").select("ra", F.col("node").alias("rb"))
        close = across.union(alike).select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        return components(nodes, texts_of(df, id, text), words, percent, known, written(close, "close"))

    return resolved(rows, search, blank=True).select("doc_id", "component_id")
