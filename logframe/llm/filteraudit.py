"""How quality filters interact: what every order of them removes, keeps and loses.

One pass turns every document into the mask of the filters that it fails, and documents are counted into
cells of part and mask.  A recursive query then extends filter prefixes by every unused letter and
carries the bits applied before; every level of the recursion says what its step does with each of
the 32 masks.  Its rows depend on the filters alone, so they are broadcast to the cells.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from logframe.llm.common import mapped, text_rows, written

LETTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
SYMBOL = re.compile(r"[#$%&*|]")
CAPITALS = bytes(range(65, 91))

PREFIXES = """
WITH RECURSIVE steps(prefix, letter, applied, bit, mask) AS (
  SELECT CAST('' AS STRING), CAST('' AS STRING), 0, 0, CAST(id AS INT) FROM range({masks})
  UNION ALL
  SELECT concat(prefix, f.letter), f.letter, applied | s.bit, f.bit, mask
  FROM steps s LATERAL VIEW inline(array({filters})) f AS letter, bit
  WHERE ((applied | s.bit) & f.bit) = 0
)
SELECT prefix, letter, CAST(length(prefix) AS INT) AS step, mask,
  (mask & (applied | bit)) = 0 AS stays, (mask & bit) <> 0 AND (mask & applied) = 0 AS goes,
  (mask & bit) <> 0 AND (mask & applied) <> 0 AS again, mask = bit AS alone
FROM steps WHERE prefix <> ''
"""


def failures(text: str | None) -> tuple[int, bytes]:
    """The bits of the filters A to D that a text fails, and the digest of the text."""
    text = text or ""
    data = text.encode()
    words = data.split()  # at the six ASCII blanks alone
    capitals = len(data) - len(data.translate(None, CAPITALS))
    failed = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT * len(words),
        100 * capitals > MOST_CAPITALS * len(text),
        SYMBOL.search(text) is not None,
    )
    return sum(1 << k for k, bad in enumerate(failed) if bad), hashlib.sha256(data).digest()


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask, digest`` of every document, the mask of the filters on the text alone."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for ids, texts in text_rows([batch]):
                found = [failures(t) for t in texts]
                columns = [pa.array(ids, pa.int64()), batch.column(2).slice(at, len(ids)), pa.array([m for m, _ in found], pa.int32()), pa.array([d for _, d in found], pa.binary())]
                at += len(ids)
                yield pa.record_batch(columns, ["doc_id", "part", "mask", "digest"])

    part = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    return mapped(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), part), judge, "doc_id long, part string, mask int, digest binary")


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents, and those labelled, by part and failed filters.

    Copies of a text are counted by digest before they meet, so that no text's copies are one
    task's; of them those with the smallest id pass filter E, and so do rows without an id.
    """
    said = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("of"))
    said = said.agg(F.max(F.expr("int(quality <=> 1)")).alias("good"), F.max(F.expr("int(toxic <=> 1)")).alias("toxic"))
    rows = judged(docs)
    rows = rows.join(said, rows.doc_id == said.of, "left").select("digest", "mask", "part", "doc_id", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    kind = ["digest", "mask", "part", "good", "toxic"]
    by_id = rows.groupBy(*kind, "doc_id").agg(F.count("*").alias("n"))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first")
    copies = by_id.groupBy(*kind).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"), first)
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    passing = F.col("unnamed") + F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    copies = copies.withColumn("passing", passing)
    split = F.array(F.struct(F.col("mask").alias("mask"), F.col("passing").alias("n")), F.struct(F.col("mask").bitwiseOR(F.lit(16)).alias("mask"), (F.col("n") - F.col("passing")).alias("n")))
    counted = copies.select("part", "good", "toxic", F.inline(split)).where("n > 0")
    return counted.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step, zeros included.

    ``docs`` needs ``doc_id, text, lang`` and ``labels`` needs ``doc_id, quality, toxic``; other columns are not read.
    A part is a language (null: the empty string).  A null text is empty.  A document with several labels has a label if one of
    them says so; one without labels has none.  Rows that repeat an id count singly, and none of them is a copy of the other.
    An empty table of documents gives no rows, one of labels no losses.
    """
    spark = docs.sparkSession
    filters = ", ".join(f"struct('{letter}', {1 << k})" for k, letter in enumerate(LETTERS))
    steps = written(spark.sql(PREFIXES.format(masks=1 << len(LETTERS), filters=filters)), "steps")  # 325 prefixes of 32 masks
    counts = written(cells(docs, labels), "cells")

    def total(of: str, when: str):
        return F.sum(F.when(F.col(when), F.col(of)).otherwise(0))

    metrics = counts.join(F.broadcast(steps), "mask").groupBy("part", "prefix", "letter", "step").agg(
        total("n", "stays").alias("kept"), total("n", "goes").alias("removed"), total("n", "again").alias("redundant"),
        total("n", "alone").alias("unique_fails"), total("good", "goes").alias("good_lost"), total("toxic", "goes").alias("toxic_lost"),
    )
    orders = F.factorial(len(LETTERS) - F.col("step"))
    metrics = metrics.withColumn("shapley", F.sum(F.col("removed") * orders).over(Window.partitionBy("part", "letter")))
    whole = steps.where(F.col("step") == len(LETTERS)).select(F.col("prefix").alias("filter_order")).distinct()
    whole = whole.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step"))
    whole = whole.withColumn("prefix", F.expr("left(filter_order, step)"))
    found = metrics.drop("step").join(F.broadcast(whole), "prefix")  # 600 rows
    return found.select("part", "filter_order", F.col("step").cast("int"), "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
