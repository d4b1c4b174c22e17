"""Merkle manifest of a table as a content-addressed DAG.

Every row is a leaf.  Leaves of a group stand in order, and every ``FANOUT`` consecutive nodes become one
parent until one is left, the group's subroot; subroots in the order of their groups grow into the root
alike.  What is stored are records from a digest to its children.  A request for a leaf descends from the
root: the digits of the group's rank and then of the leaf's rank choose a child of every record, and the children
not chosen are collected on the way.  Read from the leaf upwards, these segments are its proof.
Requests that share digits share the descent, so every record is opened once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from logframe.llm.common import lower_ascii, ranked, written

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Every row whose id has a CRC32 divisible by this is tampered with in an audit.
TAMPERED = 5


def digest_of(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it; null is ``-``."""
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf(fields: tuple[str, ...] = FIELDS, **changed: Column) -> Column:
    """The leaf of a row, some columns replaced."""
    return digest_of(*(field(changed.get(name, F.col(name))) for name in fields))


def tree_of(group: str) -> Column:
    """A group's key: not null, in the order of the groups with null first."""
    return F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))


def grow(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Records ``digest, children`` of the trees over ``nodes(tree, rank, count, digest)`` by height from 1 on, and their tops.

    The tops are ``tree, digest, height``.  Every level is a sixteenth of the one below.
    """
    most = nodes.agg(F.max("count")).first()[0] or 0
    height, records = 0, []
    tops = [nodes.where("count = 1").select("tree", "digest", F.lit(0).alias("height"))]
    while most > 1:
        height, most = height + 1, -(-most // FANOUT)
        run = nodes.where("count > 1").groupBy("tree", F.floor(F.col("rank") / FANOUT).alias("parent"), "count")
        run = run.agg(F.sort_array(F.collect_list(F.struct("rank", "digest")))["digest"].alias("children"))
        run = run.select("tree", F.col("parent").alias("rank"), F.ceil(F.col("count") / FANOUT).alias("count"), digest_of(F.array_join("children", "")).alias("digest"), "children")
        nodes = written(run, "nodes")
        records.append(nodes.select("digest", "children"))
        tops.append(nodes.where("count = 1").select("tree", "digest", F.lit(height).alias("height")))
    return records, reduce(DataFrame.union, tops)


def others(children: Column, digit: Column) -> Column:
    """The children to the left and to the right of the chosen one."""
    join = lambda part: F.array_join(part, "")
    return F.struct(join(F.slice(children, 1, digit)).alias("left"), join(F.slice(children, digit + 2, FANOUT)).alias("right"))


def descend(frontier: DataFrame, records: list[DataFrame], requests: DataFrame | None, stop: int) -> DataFrame:
    """``frontier(tree, prefix, digest, height, path, ...)`` taken down to ``stop`` levels above the nodes asked for.

    ``prefix`` are the digits chosen so far and ``path`` the segments collected; only children that have
    a node of ``requests(tree, rank)`` below them are followed, all of them without requests.  Equal records are one.
    """
    rest = [c for c in frontier.columns if c not in ("tree", "prefix", "digest", "height", "path")]
    asked = [] if requests is None else [requests.select("tree", "rank").distinct()]
    for _ in range(len(records) - 1 if asked else 0):
        asked.append(written(asked[-1].select("tree", F.floor(F.col("rank") / FANOUT).alias("rank")).distinct(), "asked"))
    for height in range(len(records), stop, -1):
        known = records[height - 1].dropDuplicates(["digest"])
        child = frontier.where(F.col("height") == height).join(known, "digest").select("*", F.posexplode("children").alias("digit", "child"))
        child = child.select(
            "tree", (F.col("prefix") * FANOUT + F.col("digit")).alias("prefix"), F.col("child").alias("digest"), F.lit(height - 1).alias("height"),
            F.concat("path", F.array(others(F.col("children"), F.col("digit")))).alias("path"), *rest,
        )
        if asked:
            child = child.join(asked[height - 1].withColumnRenamed("rank", "prefix"), ["tree", "prefix"], "left_semi")
        frontier = written(frontier.where(F.col("height") < height).select(child.columns).union(child), "frontier")
    return frontier


@dataclass
class Manifest:
    """A stored manifest: its leaves, the records, the subroots and the root."""

    #: ``tree, rank, count, digest`` and the columns kept of every row.
    leaves: DataFrame
    #: ``digest, children`` by height from 1 on, inside the groups and over the groups.
    inner: list[DataFrame]
    outer: list[DataFrame]
    #: ``tree, digest, height, rank`` of every group, ``rank`` its place among them.
    groups: DataFrame
    #: ``digest, height`` of the whole, no row for an empty table.
    root: DataFrame


def build(leaves: DataFrame, *order: str) -> Manifest:
    """The manifest over ``leaves(tree, digest, ...)``, those of a tree in the given order and then by digest."""
    nodes = written(ranked(leaves, *order, "digest"), "leaves")
    inner, tops = grow(nodes.select("tree", "rank", "count", "digest"))
    tops = written(tops, "subroots")
    whole = tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", "height")
    groups = written(ranked(whole, "name"), "groups")
    outer, root = grow(groups.select("tree", "rank", "count", "digest"))
    groups = groups.select(F.col("name").alias("tree"), "digest", "height", "rank")
    return Manifest(nodes, inner, outer, groups, written(root.select("digest", "height"), "root"))


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """``requests(tree, rank, ...)``, all leaves if left out, with ``subroot``, ``root`` and ``segments`` of the leaf.

    ``segments`` go from the leaf's own run to the root: the digests joined to the left and to the right of the way.
    """
    none = F.array().cast("array<struct<left:string,right:string>>")
    asked = manifest.groups if requests is None else manifest.groups.join(requests.select("tree").distinct(), "tree", "left_semi")
    root = manifest.root.select(F.lit("").alias("tree"), F.lit(0).cast("long").alias("prefix"), "digest", "height", none.alias("path"), F.col("digest").alias("root"))
    over = descend(root, manifest.outer, None if requests is None else asked.select(F.lit("").alias("tree"), "rank"), 0)
    over = over.select(F.col("prefix").alias("rank"), "path", "root").join(asked, "rank")
    under = over.select("tree", F.lit(0).cast("long").alias("prefix"), "digest", "height", "path", "root", F.col("digest").alias("subroot"))
    under = descend(under, manifest.inner, None if requests is None else requests.select("tree", "rank"), 1)
    if manifest.inner:
        runs = under.join(manifest.inner[0].dropDuplicates(["digest"]), "digest", "left")
    else:
        runs = under.withColumn("children", F.lit(None).cast("array<string>"))
    runs = runs.select("tree", "prefix", "children", "path", "root", "subroot")
    leaves = manifest.leaves if requests is None else requests
    found = leaves.withColumn("prefix", F.floor(F.col("rank") / FANOUT)).join(runs, ["tree", "prefix"])
    digit = (F.col("rank") % FANOUT).cast("int")
    own = F.when(F.col("children").isNull(), none).otherwise(F.array(others(F.col("children"), digit)))
    return found.withColumn("segments", F.concat(own, F.reverse("path"))).drop("prefix", "children", "path")


def proof_digest(segments: Column) -> Column:
    """The digest of all siblings of a proof, from the leaf to the root and left to right."""
    return F.sha2(F.array_join(F.transform(segments, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(start: Column, segments: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(segments, start, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def audit(df: DataFrame, id: str = "doc_id", group: str = "source", text: str = "text", fields: tuple[str, ...] = FIELDS, tampered: int = TAMPERED) -> DataFrame:
    """The manifest of ``df`` and the proof of every row, checked against tampered rows.

    One row per row: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.  Where ``tampered``
    divides the CRC32 of the id, the leaf is recomputed from the text with A-Z lowered, else it is as it was;
    ``verified`` says whether it still leads to the root.  Rows without an id come first in their group and are not tampered
    with; rows that share an id stand by their leaves, and equal rows have equal leaves at places of their own.  Rows
    without a group are a group, the first.  A null text stays null.  Only ``fields`` are read; an empty table gives no rows.
    """
    hit = F.crc32(F.col(id).cast("string").cast("binary")) % tampered == 0
    start = F.when(hit, leaf(fields, **{text: lower_ascii(F.col(text))})).otherwise(leaf(fields))
    leaves = df.select(F.col(id).alias("id"), tree_of(group).alias("tree"), leaf(fields).alias("digest"), start.alias("start"))
    manifest = build(written(leaves, "rows"), "id")
    found = prove(manifest)
    return found.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
        proof_digest(F.col("segments")).alias("proof_sha256"), folded(F.col("start"), F.col("segments")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
