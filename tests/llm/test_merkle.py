"""The Merkle manifest against a plain one built in memory."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from logframe.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, rank int, digest string, root string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grow(nodes):
    """Levels of a tree, from its leaves to the one node left."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def plain_audit(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[name] = grow([plain_leaf(r) for r in groups[name]])
    top = grow([trees[name][-1][0] for name in names])
    found = []
    for place, name in enumerate(names):
        for rank, row in enumerate(groups[name]):
            siblings, at = [], []
            for levels, where in ((trees[name], rank), (top, place)):
                for level in levels[:-1]:
                    run = level[where - where % 16 : where - where % 16 + 16]
                    siblings.append(run[: where % 16] + run[where % 16 + 1 :])
                    at.append(where % 16)
                    where //= 16
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            low = None if row[4] is None else row[4].translate({c: c + 32 for c in range(65, 91)})
            node = plain_leaf((*row[:4], low if hit else row[4]))
            for others, digit in zip(siblings, at):
                node = sha("".join(others[:digit] + [node] + others[digit:]))
            root = top[-1][0]
            proof = sha("".join(d for others in siblings for d in others))
            found.append((row[0], plain_leaf(row), trees[name][-1][0], root, proof, node, node == root))
    return sorted(found, key=str)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "t", 1, "d", "r") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in merkle.audit(df).collect()), key=str)


def made(seed, count, sources):
    drawn = random.Random(seed)
    texts = ["Aé b", "", None, "x" * 5000, "Plain Text 🙂", "lower"]
    return [(k, drawn.choice(sources), drawn.choice(["en", None]), drawn.choice([3, None]), drawn.choice(texts)) for k in range(count)]


@pytest.mark.parametrize("count, sources", [(1, ["a"]), (16, ["a"]), (17, ["a"]), (300, ["a", "b", None, "", "é", "B"]), (80, [f"s{k}" for k in range(40)])])
def test_manifest_and_proofs_against_a_plain_one(spark, count, sources):
    rows = made(count, count, sources)
    expected = plain_audit(rows)
    assert got(spark, rows) == expected
    if count >= 80:
        assert 0 < sum(not r[-1] for r in expected) < count / 3


def test_repeated_rows_missing_ids_and_a_tree_of_three_levels(spark):
    rows = [(7, "a", "en", 1, "Same")] * 40 + [(None, "a", None, None, None)] * 3 + [(9, "a", "en", 1, t) for t in ("X", "Y")] + made(2, 260, ["a"])
    assert got(spark, rows) == plain_audit(rows)
    assert got(spark, []) == []


def test_requests_open_only_what_is_asked_for(spark):
    rows = made(4, 300, ["a", "b"])
    df = spark.createDataFrame([(*r, "t", 1, "d", "r") for r in rows], SCHEMA)
    leaves = df.select("doc_id", merkle.tree_of("source").alias("tree"), merkle.leaf().alias("digest"))
    manifest = merkle.build(leaves, "doc_id")
    asked = manifest.leaves.where("doc_id IN (5, 250)")
    found = merkle.prove(manifest, asked).select("doc_id", "root", merkle.folded(merkle.F.col("digest"), merkle.F.col("segments")).alias("again")).collect()
    assert sorted(r.doc_id for r in found) == [5, 250]
    assert all(r.root == r.again for r in found)


def test_no_tree_is_one_task(spark):
    rows = spark.range(20000).selectExpr("'=a' AS tree", "sha2(string(id), 256) AS digest", "id")
    kept = merkle.ranked(rows.repartition(8), "id")
    assert kept.where("rank <> id OR count <> 20000").count() == 0
