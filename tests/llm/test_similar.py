"""The near-dedup of the pipeline against brute force over all pairs."""

from __future__ import annotations

import random

import corpus_pipeline
from logframe.llm import similar
from tests.llm.test_operators import docs, prose


def brute_sets(texts, words=5):
    out = []
    for t in texts:
        ws = (t or "").lower().split()
        out.append({tuple(ws[i : i + words]) for i in range(max(len(ws) - words + 1, 1))} if ws else set())
    return out


def brute_similar(texts, least=0.8):
    sets, label = brute_sets(texts), list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def edited(text, changes, seed):
    drawn, words = random.Random(seed), text.split()
    for at in drawn.sample(range(len(words)), changes):
        words[at] = "e%d" % drawn.randrange(10**9)
    return " ".join(words)


def test_edited_copies_are_linked_from_the_bound_up(spark):
    texts = [prose(k, 40 + 15 * k, 10**9) for k in range(20)]
    texts += [edited(texts[k], 1 + c * len(texts[k].split()) // 100, 100 * c + k) for k in range(20) for c in range(6)]
    same = prose(99, 80, 10**9)
    texts += [f"{same} {prose(200 + k, 90, 10**9)}" for k in range(50)]  # a common passage
    texts += [edited(same, 1, 300 + k) for k in range(50)]
    texts += ["one", "ONE", "one two", "a b c d e", "a b c d f", "", None]
    want = brute_similar(texts)
    got = {r.doc_id: r.component_id for r in similar.near_duplicates(docs(spark, texts)).collect()}
    assert got == dict(enumerate(want))


def test_stage_drops_edited_copies(spark):
    text = prose(1, 400, 10**9)
    table = docs(spark, [text, edited(text, 6, 2), prose(3, 400, 10**9)])
    assert [r.doc_id for r in corpus_pipeline.one_of_each(spark, table, "").collect()] == [0, 2]
