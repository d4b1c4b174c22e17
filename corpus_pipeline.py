"""A corpus pipeline in four stages over ``documents``: language, near-duplicates, repeated passages, packing.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows that the stage before kept, and returns a
DataFrame that is written as Parquet and reread as the next one's ``docs``.  All but the last return
the columns of ``docs``.  A stage uses the columns ``doc_id``, ``text`` and ``lang``; others are carried
along.  Null and empty texts have no language and go at the first stage; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from logframe.llm import chunks, langid, packing, similar
from logframe.llm.common import removed, scratch, shared_path, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are language: those without a letter go, and those of mostly other characters with a low score.

    Without a labelled row to learn from, every document with a letter stays.
    """
    return langid.keep_identified(docs, langid.train(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates; documents without an id stay.

    Near-duplicates have a similarity of 0.8 or more by shingles of five words.
    """
    found = similar.near_duplicates(docs)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    gone = written(gone, "gone")
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the passages that an earlier one has too."""
    return chunks.drop_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", with_language),
    ("SimHash near-dedup", one_of_each),
    ("substring dedup", without_repeats),
    ("packing", packed),
]

#: No SQL expresses the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread; what they left there is removed."""
    docs, last = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        path = shared_path(spark, "stage-" + name.replace(" ", "-"))
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        removed(spark, *last)
        last = [path]
    return docs
