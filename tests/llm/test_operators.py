"""The operators against brute force, on small tables with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import collections
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from logframe.llm import chunks, common, components, hashforest, langid, licenses, packing, pieces, products, sharding, simhash, vectors, warc

DOCS = "doc_id long, text string, lang string, fp int, digest string, key string, shard int, start int, score int, labels string"


def docs(spark, texts, ids=None, lang=None):
    """Documents with extra columns whose names clash with those of the operators."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, lang and lang[k], 1, "x", "y", 2, 3, 4, "z") for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, words, vocabulary=400):
    drawn = random.Random(seed)
    return " ".join("w%d" % drawn.randrange(vocabulary) for _ in range(words))


ODD = ["", None, "   \n\t ", "one", "a b c", "a b c d", "A B c D", "\x00\x1f!", "日本語 の テキスト です か", "é" * 3000, "🙂 " * 500]


# --- SimHash


def brute_fingerprint(text):
    import re

    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(ids, prints, radius):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, key in enumerate(ids):
        least[find(i)] = min(key, least.get(find(i), key))
    return {key: least[find(i)] for i, key in enumerate(ids)}


def test_fingerprints_and_components_against_brute_force(spark):
    base = prose(1, 300)
    texts = ODD + [base, base, base + " x", base.upper(), prose(2, 60), prose(3, 20000)]
    texts += [base.replace("w%d " % k, "v%d " % k, 1) for k in range(60)]
    ids = [1000 - 3 * k for k in range(len(texts))]
    got = {r.doc_id: r for r in simhash.near_duplicates(docs(spark, texts, ids)).collect()}
    prints = [brute_fingerprint(t) for t in texts]
    assert {k: got[k].fp % (1 << 64) for k in got} == dict(zip(ids, prints))
    assert {k: got[k].component_id for k in got} == brute_components(ids, prints, 4)
    assert len(set(got[k].component_id for k in got)) < len(texts) - 20


def test_repeated_rows_and_missing_ids_keep_their_place(spark):
    got = simhash.near_duplicates(docs(spark, ["a b c d e", "a b c d e", None, ""], [7, 7, 3, None])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in got) == [(False, 3, 3), (False, 7, 7), (False, 7, 7), (True, 0, 3)]
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


@pytest.mark.parametrize("shard", [4096, 16])
def test_links_connect_what_all_pairs_connect(spark, shard):
    drawn = random.Random(5)
    centres = [drawn.getrandbits(64) for _ in range(6)]
    prints = {drawn.getrandbits(64) for _ in range(50)}
    for c in centres:
        for _ in range(60):
            x = c
            for _ in range(drawn.randrange(9)):
                x ^= 1 << drawn.randrange(64)
            prints.add(x)
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), 4, shard=shard).collect()
    assert all(bin((e.a ^ e.b) % (1 << 64)).count("1") <= 64 for e in edges)
    found = {r.node: r.label for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {p: found.get(p, p) for p in prints} == brute_components(prints, [p % (1 << 64) for p in prints], 4)


def test_forest_finds_all_within_the_radius():
    drawn = np.random.default_rng(3)
    values = np.unique(drawn.integers(0, 1 << 12, 600).astype(np.uint64))
    group = np.sort(drawn.integers(0, 3, len(values)))
    forest = simhash.Forest(group, values)
    found = {(q, n) for a, b in forest.within(values, group, 3) for q, n in zip(a.tolist(), b.tolist())}
    apart = np.bitwise_count(values[:, None] ^ values[None])
    assert found == set(zip(*map(np.ndarray.tolist, np.nonzero((apart <= 3) & (group[:, None] == group[None])))))


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(5, 5)]
    found = {r.node: r.label for r in components.connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


# --- substring dedup


def test_cuts_cover_the_text_and_move_with_it():
    text = prose(4, 3000).encode()
    borders = chunks.cuts(text)
    assert borders[0] == 0 and borders[-1] == len(text) and borders == sorted(set(borders))
    assert max(np.diff(borders)) <= chunks.LONGEST
    pieces_ = {text[a:b] for a, b in zip(borders, borders[1:])}
    moved = b"inserted here " + text
    again = chunks.cuts(moved)
    assert len(pieces_ & {moved[a:b] for a, b in zip(again, again[1:])}) > 0.98 * len(pieces_)
    assert chunks.cuts(b"") == [0] and chunks.cuts(b"a" * 5000)[-1] == 5000
    for a in chunks.cuts(("é🙂" * 4000).encode()):
        ("é🙂" * 4000).encode()[:a].decode()


def test_candidates_follow_the_rolling_hash():
    data = np.frombuffer(prose(6, 500).encode(), np.uint8)
    h, at = 0, []
    for i, b in enumerate(data.tolist()):
        h = (h << 1) + int(chunks.GEAR[b])
        if not h & int(chunks.MASK) and i + 1 < len(data):
            at.append(i + 1)
    assert chunks.candidates(data).tolist() == at


def test_passages_are_found_and_taken_out(spark):
    passage = prose(7, 60, 10**9)
    texts = [f"{prose(k + 100, 40, 10**9)} {passage} {prose(k + 200, 40, 10**9)}" for k in range(12)]
    clean = [prose(k + 300, 90, 10**9) for k in range(12)]
    table = docs(spark, texts + clean + ODD[:4] + [None], [*range(28), None])
    found = chunks.repeats(table).collect()
    assert {r.doc_id for r in found} == set(range(1, 12)) and all(r.first_ids[0] == 0 for r in found)
    for r in found:
        inner = texts[r.doc_id].encode()[r.start : r.start + r.size].decode().split(" ")[1:-1]  # a run may begin inside a word before it
        assert len(inner) > 15 and " ".join(inner) in passage
    kept = {r.doc_id: r.asDict() for r in chunks.drop_repeats(table).collect()}
    assert len(kept) == 29 and kept[0]["text"] == texts[0] and kept[12]["text"] == clean[0] and kept[25]["text"] is None
    assert kept[3]["key"] == "y" and list(kept[3]) == table.columns
    for k in range(1, 12):
        assert passage not in kept[k]["text"] and set(kept[k]["text"].split()) <= set(texts[k].split())
        assert kept[k]["text"].startswith(prose(k + 100, 40, 10**9)) and kept[k]["text"].endswith(prose(k + 200, 40, 10**9))


def test_whole_copies_leave_an_empty_text(spark):
    text = prose(8, 100)
    kept = sorted(chunks.drop_repeats(docs(spark, [text, text, text])).select("doc_id", "text").collect())
    assert [tuple(r) for r in kept] == [(0, text), (1, ""), (2, "")]
    assert chunks.drop_repeats(docs(spark, [])).count() == 0 and chunks.repeats(docs(spark, [])).count() == 0


# --- WARC


def test_archives_round_trip(spark):
    rows = [(k, f"http://WWW.H{k % 3}.Example.org:80/p{k % 7}?q#f", h) for k, h in enumerate(["<p>a</p>", "", None, "<p>a</p>", "é" * 5000, "x", "<p>a</p>", ""])]
    rows += [(None, None, "z"), (20, "", "x"), (20, "", "x"), (30, "not a url\r\n", "w")]
    pages = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, key int, file int")
    captures = warc.write_archives(pages)
    assert captures.count() == len(rows)
    files = warc.write_index(captures)
    got = sorted(((r.page_id if r.page_id is not None else -1, bytes(r.payload), r.record_type, r.refers_to) for r in warc.look_up(files, captures).collect()), key=str)
    last = {}
    for key, _, html in rows:
        if key is not None:
            last[html or ""] = max(key, last.get(html or "", key))
    want = []
    for key, _, html in rows:
        original = last.get(html or "") if key is not None else None
        revisit = original is not None and original > key
        want.append((key if key is not None else -1, b"" if revisit else (html or "").encode(), "revisit" if revisit else "response", original if revisit else None))
    assert got == sorted(want, key=str)


def test_look_up_over_several_blocks_and_files(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://hot.example.com/"), F.col("id") % 5).alias("url"), F.concat(F.lit("p"), "id").alias("html"))
    captures = warc.write_archives(pages.repartition(3))
    files = warc.write_index(captures)
    got = {r.page_id: bytes(r.payload) for r in warc.look_up(files, captures).collect()}
    assert got == {k: b"p%d" % k for k in range(3000)}
    nowhere = spark.createDataFrame([(5000, "com,example,hot)/1"), (1, "com,nowhere)/")], "page_id long, key string")
    assert warc.look_up(files, nowhere).count() == 0
    assert warc.write_index(warc.write_archives(pages.limit(0))) == []


def test_archives_are_looked_up_by_several_tasks(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    captures = warc.write_archives(pages)
    files = warc.write_index(captures)
    assert len(files) >= 4 and [f[:2] for f in files] == sorted((f[:2] for f in files), key=lambda f: warc.sort_key(*f))
    found = warc.look_up(files, captures)
    rows = found.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(rows) >= 4 and sum(r["count"] for r in rows) == pages.count() and max(r["count"] for r in rows) < pages.count() / 2
    assert warc.tasks_for(captures, F.sum("size"), 1000) > warc.tasks_for(captures, F.sum("size"), 1 << 40) == spark.sparkContext.defaultParallelism


def test_url_key(spark):
    urls = ["http://www.A.example.org:8080/X?b=1#t", "https://b.org", "", None, "ftp://u.de/ a"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(warc.url_key(F.col("u"))).collect()]
    assert got == ["org,example,a)/x?b=1", "org,b)", "-)", "-)", "de,u)/a"]


# --- sharding


def brute_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, held = (low + high) // 2, 1, 0
        for s in sizes:
            if held + s > middle:
                used, held = used + 1, 0
            held += s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize(("cells", "spread", "count"), [(4096, 1, 300), (4, 1, 300), (8, 10**15, 500), (4, 3, 5)])
def test_capacity_is_the_least(spark, monkeypatch, cells, spread, count):
    monkeypatch.setattr(sharding, "CELLS", cells)
    drawn = random.Random(count)
    keys = sorted(drawn.sample(range(count * 4), count))
    sizes = [drawn.choice([1, 5, 40, 900]) for _ in keys]
    sizes[count // 2] = 9000
    groups = spark.createDataFrame([(k * spread - 7, s) for k, s in zip(keys, sizes)], "key long, total long")
    capacity, cuts = sharding.capacity_and_cuts(groups, 16)
    assert capacity == brute_capacity(sizes, 16)
    shard_of = [sum(k * spread - 7 >= c for c in cuts) for k in keys]
    total = collections.Counter()
    for s, n in zip(shard_of, sizes):
        total[s] += n
    assert max(total.values()) == capacity and len(cuts) < 16


def test_shards_keep_groups_and_number_rows(spark):
    texts = [prose(k % 90, 5 + k % 50) for k in range(400)] + ["", "", None, None]
    ids = [5 * k for k in range(403)] + [None]
    rows = sharding.shard(docs(spark, texts, ids), 16).collect()
    assert len(rows) == 404
    by_id = dict(zip(ids, texts))
    of_text, slots = collections.defaultdict(set), collections.defaultdict(list)
    for r in rows:
        raw = (by_id[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        of_text[by_id[r.doc_id]].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(docs(spark, [])).count() == 0


@pytest.mark.parametrize("kind", ["hashed", "null", "same"])
def test_slots_do_not_depend_on_the_ids(spark, kind):
    n = 60_000
    doc_id = {"hashed": F.xxhash64("id"), "null": F.lit(None).cast("long"), "same": F.lit(7).cast("long")}[kind]
    table = spark.range(0, n, 1, 8).select(doc_id.alias("doc_id"), F.lit("a").alias("text") if kind == "same" else F.concat(F.lit("t"), F.col("id") % 5000).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be put together
    try:
        found = common.written(sharding.shard(table, 4).withColumn("task", F.spark_partition_id()), "slots")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spread = found.groupBy("task").count().collect()
    slots = found.groupBy("shard").agg(F.min("slot").alias("low"), F.max("slot").alias("high"), F.count("*").alias("n"), F.countDistinct("slot").alias("d")).collect()
    assert sum(r.n for r in slots) == n and all((r.low, r.high + 1) == (0, r.n) and r.d == r.n for r in slots)
    assert len(spread) >= 4 and max(r["count"] for r in spread) < n / 2
    if kind == "hashed":
        order = found.where("doc_id IS NOT NULL").selectExpr("shard", "slot", "lag(doc_id) OVER (PARTITION BY shard ORDER BY slot) < doc_id AS up")
        assert order.where("NOT up").count() == 0


# --- licenses


def brute_labels(text):
    import re

    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    find = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", s)
    words, base = find(low), []
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        base += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    best = {}
    for template, label in licenses.TEMPLATES:
        length, want = len(find(template.lower())), set(find(template.lower()))
        few = len(want) < licenses.NAMED
        for i in range(len(words)):
            have = set(words[i : i + (length if few else -(-5 * length // 4))])
            share = len(want & have) / len(want)
            named = not few or licenses.NAMES.get(label, "") in have | {""}
            if share >= 0.8 - 1e-9 and named:
                best[label] = max(share, best.get(label, 0))
    at = [i for i, _ in base]
    of_base = sorted({v for _, v in base})
    score = 1.0 if base else max(best.values(), default=0.0)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(of_base), ",".join(sorted({*of_base, *best})), score


def test_licenses_against_brute_force(spark):
    drawn = random.Random(2)
    texts = [*ODD, "MIT  license. mit-LICENSE mit license license", "\n\nLicensed under the Apache\nLicense", "K license mit"]
    for template, _ in licenses.TEMPLATES:
        words = template.split()
        for drop in (0, 1, 2, 4, 6):
            some = drawn.sample(words, max(len(words) - drop, 1)) + prose(drop, 30).split()
            drawn.shuffle(some)
            texts += [" ".join(some), f"{prose(3, 20)}\n{template}\n{prose(4, 20)}"]
    texts.append(prose(1, 9000) + "\nmit license " * 50)
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(docs(spark, texts)).collect()}
    assert got == {k: brute_labels(t) for k, t in enumerate(texts)}
    again = licenses.scan(docs(spark, ["mit license", "mit license", "x"], [1, 1, None]))
    assert sorted(r.labels for r in again.collect()) == ["", "mit", "mit"]
    assert licenses.scan(docs(spark, [])).count() == 0


WRAPPED = {
    "mit": "/*\n * Permission is hereby granted, free of charge, to any person obtaining\n * a copy of this software and associated documentation\n * files (the \"Software\"), to deal in the Software",
    "bsd": "# Redistribution and use in source and binary forms, with or\n# without modification, are permitted provided that the following\n# conditions are met:",
    "gpl": "This program is free software: you can redistribute it and/or\r\nmodify it under the terms of the GNU General\r\nPublic License as published",
    "apache-2.0": "Licensed under the Apache\n License, Version 2.0 (the \"License\"); you\n may not use this file except in\n compliance with the License.",
}


def test_wrapped_headers_are_found_and_scattered_words_are_not(spark):
    false = [
        "software is not released under the apache licence",
        "the mit people were released and under no license apache said version of 2 others was 0 licensed to them",
        " ".join(prose(5, 200) + f" {w}" for w in template_order("Released under the MIT License")) * 5,
        "released under the new license",
    ]
    got = {r.doc_id: r.labels.split(",") for r in licenses.scan(docs(spark, [*WRAPPED.values(), *false])).collect()}
    assert all(label in got[k] for k, label in enumerate(WRAPPED))
    assert all(got[k] == [""] for k in range(len(WRAPPED), len(got)))


def template_order(text):
    return text.lower().split()


def test_a_word_repeated_very_often_is_no_burden(spark):
    text = "mit " * 60_000 + "Released under the MIT License " + "mit the " * 20_000
    (row,) = licenses.scan(docs(spark, [text])).collect()
    assert (row.n_words, row.labels, row.n_base, row.first_word) == (100_005, "mit", 1, 60_003)


def test_native_operators_run_no_python(spark):
    table = docs(spark, ["mit license", "b"])
    for df in (licenses.scan(table), sharding.shard(table)):
        plan = df._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


# --- language


def test_language_is_learned_from_the_right_rows(spark):
    kinds = {"en": "the and with from that", "de": "der und mit von dass", "fr": "le et avec dans que", "es": "el y con desde que", "xx": "zzq qqz zqz"}
    drawn = random.Random(9)
    texts, langs = [], []
    for k in range(500):
        lang = drawn.choice(list(kinds))
        texts.append(" ".join(drawn.choice(kinds[lang].split()) for _ in range(40)))
        langs.append(lang)
    texts += ["123 !!", "", None, "日"]
    langs += ["en", None, "de", None]
    table = docs(spark, texts, lang=langs)
    got = {r.doc_id: r for r in langid.identify(table, langid.train(table)).collect()}
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k in got)
    held = [k for k in range(500) if got[k].held_out]
    assert len(held) > 80 and sum(got[k].lang_pred == langs[k] for k in held) == len(held)
    assert [got[k].lang_pred for k in (500, 501, 502)] == ["und"] * 3 and got[503].lang_pred in kinds
    assert all(0 <= r.score <= 1 for r in got.values())
    wrong = table.withColumn("lang", F.when(langid.held_out("doc_id"), F.lit("es")).otherwise(F.col("lang")))
    assert {r.doc_id: r.lang_pred for r in langid.identify(wrong, langid.train(wrong)).collect()} == {k: r.lang_pred for k, r in got.items()}


def test_nothing_to_learn_from(spark):
    table = docs(spark, ["abc", None])
    assert langid.train(table) is None
    assert [r.lang_pred for r in langid.identify(table, None).collect()] == ["und", "und"]
    assert langid.train(docs(spark, ["abc", "abd"], [1, 3], ["en", "en"])) is not None
    assert langid.identify(docs(spark, []), None).count() == 0


# --- packing


def test_ids_are_those_of_the_tokenizers_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.encoder(packing.vocabulary())
    for text in [*(t for t in ODD if t is not None), " a", "a  b", "a\n b", "x <|endoftext|> y", "it's 's", "tab\tx  ", "a  b", prose(1, 500)]:
        assert encode(text).tolist() == reference.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [64, 2048])
def test_pieces_fill_sequences(spark, size):
    texts = ODD + [prose(k, (k * 37) % 900) for k in range(150)] + [prose(1, 6000)] * 5
    ids = [*range(len(texts) - 1), None]
    encode = packing.encoder(packing.vocabulary())
    rows = packing.pack(docs(spark, texts, ids), size).collect()
    want = {i: np.append(encode(t or ""), np.uint32(1)) for i, t in zip(ids, texts)}
    of_doc, of_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        part = want[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(part.astype("<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(want[r.doc_id])
        of_doc[r.doc_id].append((r.start, r.length))
        of_sequence[r.sequence_id].append((r.offset, r.length))
    assert of_doc.keys() == want.keys()
    for key, spans in of_doc.items():
        assert sum(n for _, n in spans) == len(want[key]) and len({s for s, _ in spans}) == len(spans)
    for spans in of_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    assert sorted(of_sequence) == list(range(len(of_sequence)))
    tokens = sum(len(x) for x in want.values())
    assert len(of_sequence) <= 1.1 * tokens / size + 2
    assert packing.pack(docs(spark, [])).count() == 0


def plain_packs(histogram, size):
    """Rooms left by placing piece by piece, longest first, into the pack with most room."""
    rooms = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            most = max(range(len(rooms)), key=rooms.__getitem__, default=None)
            if most is None or rooms[most] < length:
                rooms.append(size - length)
            else:
                rooms[most] -= length
    return sorted(rooms)


def check_patterns(histogram, size):
    found = packing.patterns(histogram, size)
    used, rooms = collections.Counter(), []
    for count, pattern in found:
        filled = sum(length * times for length, times in pattern)
        assert count > 0 and 0 < filled <= size
        rooms += [size - filled] * count
        for length, times in pattern:
            used[length] += count * times
    assert used == collections.Counter(histogram) and len(found) <= 3 * size
    return sorted(rooms)


def test_patterns_are_those_of_a_plain_packer():
    drawn = random.Random(1)
    for case in range(60):
        size = drawn.choice([16, 64, 300])
        lengths = drawn.sample(range(1, size + 1), drawn.randrange(1, min(size, 20)))
        histogram = {k: drawn.randrange(1, 40) for k in lengths}
        assert check_patterns(histogram, size) == plain_packs(histogram, size)


@pytest.mark.parametrize(
    "histogram",
    [
        {5: 2000}, {301: 100_000}, {1: 5000}, {2048: 7, 1: 1}, {1025: 3000, 1: 10}, {k: 250 for k in range(20, 61)},
        {k: int(3000 / k) for k in range(8, 400)}, {k: 1 + 7919 * k % 2000 for k in range(1, 2049, 3)}, {1500: 900, 500: 2000, 40: 9000},
    ],
)
def test_padding_is_within_what_the_longest_length_can_leave(histogram):
    rooms = check_patterns(histogram, 2048)
    # no packer does with fewer than the tokens fill, or than there are pieces of more than half
    tokens = sum(k * n for k, n in histogram.items())
    over_half = sum(n for k, n in histogram.items() if 2 * k > 2048)
    waste = max((2048 % k for k in histogram), default=0)
    assert len(rooms) <= max(over_half, -(-tokens // (2048 - waste))) * 1.1 + 1


def test_short_texts_fill_few_sequences(spark):
    rows = packing.pack(docs(spark, ["w w w w"] * 2000 + [None] * 10)).collect()
    lengths = {r.length for r in rows}
    assert len({r.sequence_id for r in rows}) == -(-sum(r.length for r in rows) // 2048) and len(rows) == 2010
    ends = collections.defaultdict(list)
    for r in rows:
        ends[r.sequence_id].append((r.offset, r.offset + r.length))
    for spans in ends.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= 2048
    assert len(lengths) == 2


# --- vectors


def embeddings(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, 0) for r in rows], f"vec_id long, embedding array<{kind}>, score int")


def vector_rows(n, dim, seed):
    drawn = np.random.default_rng(seed)
    rows = [(k, [float(np.float32(x)) for x in drawn.standard_normal(dim)]) for k in range(n)]
    rows[7] = (7, rows[3][1])
    rows[200] = (200, rows[100][1])
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [nan] * dim, [inf] * dim, [None] * dim, [0.0] * dim]
    return rows + [(1000 * k + n, v) for k, v in enumerate(bad)] + [(None, rows[0][1]), rows[5], (900_000, [1.0, 2.0]), (900_001, [1.0, 2.5])]


def usable(rows, zero):
    return {k: v for k, v in rows if k is not None and v and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v))}


def test_products_against_brute_force(spark):
    rows = vector_rows(450, 12, 1)
    valid = {k: [int(np.floor(1024 * x)) for x in v] for k, v in usable(rows, True).items()}
    want = []
    for q in (k for k in valid if k % 100 == 0):
        scored = sorted((-sum(a * b for a, b in zip(valid[q], v)), k) for k, v in valid.items() if k != q and len(v) == len(valid[q]))
        want += [(q, r + 1, k, -s) for r, (s, k) in enumerate(scored[:10])]
    got = sorted(tuple(r) for r in products.top_products(embeddings(spark, rows)).collect())
    assert got == sorted(want)
    huge = products.top_products(embeddings(spark, [(0, [1e200, 3.0]), (1, [1e200, 1.0]), (2, [-1e200, 0.0])], "double")).collect()
    assert [(r.vec_id, r.score) for r in huge] == [(1, products.LIMIT), (2, -products.LIMIT - 1)]


def test_rows_that_share_an_id_all_take_part(spark):
    drawn = random.Random(8)
    rows = [(k % 150, [drawn.randrange(-9, 9) / 8, drawn.randrange(-9, 9) / 8, drawn.randrange(1, 9) / 8]) for k in range(400)]
    rows += rows[:60]
    distinct = sorted({(k, tuple(v)) for k, v in rows})
    scaled = [(k, [int(np.floor(1024 * x)) for x in v]) for k, v in distinct]
    want, near = [], []
    for q in (0, 100):
        scored = sorted((-sum(a * b for a, b in zip(u, v)), k) for i, u in scaled if i == q for k, v in scaled if k != q)[:10]
        want += [(q, r, k, -s) for r, (s, k) in enumerate(scored, 1)]
        apart = sorted((float(np.sqrt(np.square(np.subtract(u, v)).sum())), k) for i, u in distinct if i == q for k, v in distinct if k != q)[:10]
        near += [(q, r, d) for r, (d, _) in enumerate(apart, 1)]
    assert sorted(tuple(r) for r in products.top_products(embeddings(spark, rows)).collect()) == want
    got = sorted((r.query_id, r["rank"], r.score) for r in hashforest.neighbours(embeddings(spark, rows)).collect())
    assert [x[:2] for x in got] == [x[:2] for x in near] and all(a[2] >= b[2] - 1e-12 for a, b in zip(got, near))


def test_products_of_the_largest_numbers(spark):
    rows = [(0, [1e306, 1.0]), (1, [1.7e308, 2.0]), (2, [-1e306, 0.5]), (3, [0.0, 7.0]), (4, [5e-324, 3.0])]
    got = [(r.vec_id, r.score) for r in products.top_products(embeddings(spark, rows, "double")).collect()]
    assert got == [(1, products.LIMIT), (3, 7 * 1024 * 1024), (4, 3 * 1024 * 1024), (2, -products.LIMIT - 1)]


def test_neighbours_are_near_and_exactly_measured(spark):
    rows = vector_rows(900, 16, 2)
    valid = {k: np.array(v) for k, v in usable(rows, False).items()}
    got = collections.defaultdict(list)
    for r in sorted(hashforest.neighbours(embeddings(spark, rows)).collect()):
        assert r.score == pytest.approx(float(np.sqrt(np.square(valid[r.vec_id] - valid[r.query_id]).sum())), abs=1e-12)
        got[r.query_id].append((r.score, r.vec_id, r["rank"]))
    hits = total = 0
    for q in (k for k in valid if k % 100 == 0):
        best = sorted((float(np.sqrt(np.square(v - valid[q]).sum())), k) for k, v in valid.items() if k != q and len(v) == len(valid[q]))[:10]
        assert [x[2] for x in got[q]] == list(range(1, len(best) + 1)) and [x[:2] for x in got[q]] == sorted(x[:2] for x in got[q])
        hits += len({k for _, k in best} & {k for _, k, _ in got[q]})
        total += len(best)
    assert hits >= 0.9 * total
    assert got[100][0][1] == 200 and [x[1] for x in got[900_000]] == [900_001]
    assert hashforest.neighbours(embeddings(spark, [])).count() == 0 and products.top_products(embeddings(spark, [])).count() == 0


def test_recall_on_the_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = sorted((r.vec_id, r.embedding) for r in table.collect())
    ids, m = np.array([k for k, _ in data]), np.array([v for _, v in data])
    hits = 0
    got = collections.defaultdict(set)
    for r in hashforest.neighbours(table).collect():
        got[r.query_id].add(r.vec_id)
    queries = ids[ids % 100 == 0]
    for q in queries.tolist():
        apart = np.square(m - m[ids == q]).sum(1)
        apart[ids == q] = np.inf
        hits += len(set(ids[np.argsort(apart)[:10]].tolist()) & got[q])
    assert hits >= 0.9 * 10 * len(queries)


def test_tiles_give_the_same_as_one(spark, monkeypatch):
    rows = vector_rows(1500, 8, 4)
    whole = sorted(map(tuple, products.top_products(embeddings(spark, rows)).collect()))
    monkeypatch.setattr(vectors, "TILE_BYTES", 1)
    monkeypatch.setattr(vectors, "FAN_IN", 2)
    monkeypatch.setattr(products, "ROWS", 50)
    monkeypatch.setattr(products, "QUERIES", 3)
    assert sorted(map(tuple, products.top_products(embeddings(spark, rows)).collect())) == whole


# --- pieces


def brute_pieces(codec, scores, text):
    best = [(0.0, ())] + [None] * len(text)
    for end in range(1, len(text) + 1):
        options = []
        for start in range(max(0, end - 20), end):
            if text[start:end] in scores:
                i, s = scores[text[start:end]]
                options.append((best[start][0] + s, end - start, best[start][1] + (i,)))
        if text[end - 1] not in scores:
            raw = tuple(codec.bytes[b] for b in text[end - 1].encode())
            options.append((best[end - 1][0] + codec.worst, 1, best[end - 1][1] + raw))
        score, _, ids = max(options, key=lambda o: o[:2])
        best[end] = (score, ids)
    return list(best[-1][1])


def test_pieces_against_brute_force_and_back(spark):
    import sentencepiece

    codec = pieces.codec(pieces.model())
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model())
    scores = {sp.id_to_piece(i): (i, sp.get_score(i)) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    texts = ["Hello world", "  two  blanks ", "tab\tand\nline", "naïve 日本語 🙂🙂", "a" * 50, prose(1, 80), "éééé", " ", "x▁y"]
    for text in texts:
        ids = codec.encode(text).tolist()
        assert ids == brute_pieces(codec, scores, "▁" + text.replace(" ", "▁"))
        assert codec.decode(np.array(ids)) == sp.decode(ids)
        assert codec.decode(np.array(ids)) == text.replace("▁", " ")
    table = docs(spark, [*texts, None, ""])
    ids = pieces.encoded(table)
    back = {r.doc_id: r.text for r in pieces.decoded(ids).collect()}
    assert back == {**{k: t.replace("▁", " ") for k, t in enumerate(texts)}, len(texts): None, len(texts) + 1: ""}
    rows = {r.doc_id: r for r in pieces.digests(docs(spark, ODD)).collect()}
    assert all(r.round_trip and r.decoded_crc32 == zlib.crc32((ODD[k] or "").encode()) for k, r in rows.items())
    assert rows[0].n_ids == rows[1].n_ids == 0 and pieces.digests(docs(spark, [])).count() == 0


# --- shared helpers


def test_the_package_is_sent_to_workers_that_cannot_find_it(spark, monkeypatch, tmp_path):
    monkeypatch.chdir(tmp_path)
    monkeypatch.delenv("PYTHONPATH", raising=False)
    for _ in range(2):
        common.with_package(spark)
    assert sum(f.endswith("/logframe.zip") for f in spark.sparkContext.listFiles) == 1


def test_only_local_sessions_get_a_folder_of_their_own(spark):
    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("Context", (), {"master": "yarn"})

    assert common.shared_folder(spark) == common.shared_folder(spark)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(Cluster())
