"""Repeated passages against brute force over windows of words."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from logframe.llm import chunks
from tests.llm.test_operators import docs, prose


def brute_repeats(texts, least=51):
    """The byte spans of each text that lie in windows of words which an earlier text has."""
    seen, out = set(), {}
    for k, text in enumerate(texts):
        words, at, spans, own = text.split(" "), [0], [], set()
        for w in words:
            at.append(at[-1] + len(w.encode()) + 1)
        for i in range(len(words) - least + 1):
            window = " ".join(words[i : i + least])
            own.add(window)
            if window in seen:
                a, b = at[i], at[i + least] - 1
                if spans and a < spans[-1][1]:
                    spans[-1][1] = b
                else:
                    spans.append([a, b])
        seen |= own
        out[k] = [(a, b - a) for a, b in spans]
    return {k: v for k, v in out.items() if v}


def spans_of(rows):
    out = {}
    for r in sorted(rows):
        out.setdefault(r.doc_id, []).append((r.start, r.size))
    return out


def drawn_words(seed, n, letters, size):
    drawn = random.Random(seed)
    return " ".join("".join(drawn.choice(letters) for _ in range(size)) for _ in range(n))


def test_common_chunks_of_several_documents_are_no_passage(spark):
    phrases = [prose(1000 + k, 9, 10**9) for k in range(30)]
    texts = [f"{prose(k, 30, 10**9)} {p} {prose(100 + k, 30, 10**9)}" for k, p in enumerate(phrases)]
    texts.append(" ".join(phrases))  # all of it stands somewhere, but not as a passage
    drawn = random.Random(5)
    texts += [" ".join(drawn.choice(["the", "cat", "sat", "on", "a", "mat"]) for _ in range(200)) for _ in range(60)]
    assert brute_repeats(texts) == {}
    assert chunks.repeats(docs(spark, texts)).collect() == []
    assert {r.doc_id: r.text for r in chunks.drop_repeats(docs(spark, texts)).collect()} == dict(enumerate(texts))


@pytest.mark.parametrize("size", [1, 2, 3, 6])
def test_passages_of_short_words_are_found_to_their_ends(spark, size):
    texts = []
    for k in range(40):
        passage = drawn_words(k, 51 if k % 2 else 50, "abcdefghijklmnopqrstuvwxyz", size)
        texts += [f"{prose(100 + k, 30, 10**9)} {passage} {prose(200 + k, 30, 10**9)}", f"{prose(300 + k, 17, 10**9)} {passage} {prose(400 + k, 9, 10**9)}"]
    want = brute_repeats(texts)
    assert len(want) == 20 and spans_of(chunks.repeats(docs(spark, texts)).collect()) == want


def test_one_repeated_word_and_broken_runs(spark):
    period = " ".join(["ab"] * 400)
    x, y = prose(1, 60, 10**9), prose(2, 60, 10**9)
    texts = [f"{prose(3, 20, 10**9)} {period}", f"start {prose(4, 25, 10**9)} {period} end", x, y, f"{y} {x}", f"{x} new {y}"]
    assert spans_of(chunks.repeats(docs(spark, texts)).collect()) == brute_repeats(texts)


def test_scripts_without_blanks(spark):
    drawn = random.Random(3)
    passage = "".join(chr(drawn.randrange(0x4E00, 0x9000)) for _ in range(60))
    texts = ["甲乙" + passage + "丙", "丁" + passage + "戊己"]
    assert [r.text for r in chunks.drop_repeats(docs(spark, texts)).orderBy("doc_id").collect()] == [texts[0], "丁戊己"]


def test_two_texts_under_one_id(spark):
    passage = prose(1, 60, 10**9)
    other = prose(2, 130, 10**9)
    table = docs(spark, [f"{passage} a", f"b {passage}", other, other], [1, 5, 5, 5])
    assert sorted(r.text for r in chunks.drop_repeats(table).where("doc_id = 5").collect()) == sorted(["b ", other, other])
    one = spark.createDataFrame([("é x",)], "t string").select(F.xxhash64("t")).first()[0]
    assert one == chunks.text_digest("é x".encode())


@pytest.mark.parametrize("seed", range(3))
def test_passages_of_several_holders_against_brute_force(spark, seed):
    """Texts put together from pieces of others, of short and long words, with hot pieces and edits."""
    drawn = random.Random(seed)
    pool = [drawn_words(100 * seed + k, drawn.randrange(20, 160), "abcdefgh" if k % 3 else "ab", drawn.randrange(1, 7)) for k in range(14)]
    texts = []
    for k in range(60):
        parts = []
        for _ in range(drawn.randrange(1, 5)):
            words = pool[min(int(drawn.expovariate(0.4)), 13)].split(" ")
            at = drawn.randrange(max(len(words) - 30, 1))
            part = words[at : at + drawn.randrange(10, 140)]
            if drawn.random() < 0.3:
                part[drawn.randrange(len(part))] = "edit%d" % drawn.randrange(9)
            parts += part + [drawn_words(drawn.randrange(10**6), drawn.randrange(4), "xyz", 3)] * (drawn.random() < 0.5)
        texts.append(" ".join(p for p in parts if p))
    want = brute_repeats(texts)
    assert len(want) > 5 and spans_of(chunks.repeats(docs(spark, texts)).collect()) == want


def test_a_window_determines_chunks_wherever_it_stands():
    """Every window of words finds the same grams inside itself in any context."""
    drawn = random.Random(6)
    for size in (1, 2, 3, 5, 9):
        passage = drawn_words(size, 51, "abcdefghij", size)
        found = []
        for k in range(12):
            text = " ".join(w for w in (drawn_words(50 + k, drawn.randrange(40), "klmn", 4), passage, drawn_words(90 + k, drawn.randrange(40), "klmn", 3)) if w).encode()
            parts = chunks.layout(text)
            first = int(parts.start.searchsorted(text.index(passage.encode())))
            none = chunks.windows_of(parts, parts.border[:0], 51)
            assert not none[first]  # some gram is determined, and it is not shared
            inside = [(a, b) for a, b in zip(parts.border, parts.border[chunks.GRAM :]) if parts.start[first] + 16 <= a and b <= parts.end[first + 50]]
            found.append({text[a:b] for a, b in inside})
        assert set.intersection(*found)


def test_a_passage_in_every_document_is_no_one_tasks_work(spark):
    passage = prose(1, 120, 10**9)
    texts = [f"{prose(10 + k, 3, 10**9)} {passage} {prose(5000 + k, 3, 10**9)}" for k in range(1500)]
    table = docs(spark, texts)
    rows = chunks.split(table, "doc_id", "text", 51)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shared = chunks.holders(rows).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
        found = chunks.repeats(table).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total = sum(r["count"] for r in shared)
    assert len(shared) >= 6 and max(r["count"] for r in shared) < 0.3 * total
    assert {r.doc_id for r in found} == set(range(1, 1500)) and all(r.size == len(passage) for r in found)
