"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

A block is a run of words from any word of the text on, a quarter longer than the template it is held against; line
ends are gaps like others.  It meets a template if it has at least the share ``threshold`` of the
template's distinct words.  For a template of few words it is no longer than that and needs the word that names the license.  Words are ordered by their frequency over all
texts, rarest first.  A template of n words that needs a overlapping ones shares one of its first n - a + 1 words (its prefix)
with every block that meets it.  So the join is on prefix words: only blocks around a prefix word are formed, and
only if enough words of templates lie near it (length and position).  The text is read once: what is
kept of it are the words that some template or phrase has, with their places.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from logframe.llm.common import lower_ascii, written

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases and their labels (fixed values).
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Sentences by which licenses are known, and their labels (fixed values).
TEMPLATES = (
    ("Released under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software", "mit"),
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("You may not use this file except in compliance with the License", "apache-2.0"),
    ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS", "apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "lgpl"),
    ("You should have received a copy of the GNU Affero General Public License along with this program", "agpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software", "bsd-3-clause"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License", "mpl"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
)
#: The word that a block needs for a template of fewer than ``NAMED`` distinct words (fixed values).
NAMES = {"mit": "mit", "apache-2.0": "apache"}
NAMED = 10


def template_words(text: str) -> list[str]:
    """The distinct words of a template."""
    return sorted(set("".join(c if c.isalnum() else " " for c in text.lower()).split()))


class Template(NamedTuple):
    """A template as a set: its words, how many a block needs, a block's words, and the word it needs if any."""

    words: list[str]
    needed: int
    block: int
    name: str | None
    label: str


def as_sets(templates=TEMPLATES, threshold: float = 0.8) -> list[Template]:
    """The templates that have words."""
    found = []
    for text, label in templates:
        ws = template_words(text)
        if ws:
            length = len("".join(c if c.isalnum() else " " for c in text.lower()).split())
            short = len(ws) < NAMED
            found.append(Template(ws, math.ceil(threshold * len(ws) - 1e-9), length if short else -(-5 * length // 4), NAMES.get(label) if short else None, label))
    return found


def vocabulary(sets: list[Template], phrases=PHRASES) -> list[str]:
    """All words of templates and phrases."""
    return sorted({w for t in sets for w in t.words} | {w for phrase, _ in phrases for w in phrase.split()})


def known_words(df: DataFrame, id: str, text: str, wanted: list[str]) -> DataFrame:
    """``row, doc_id, n_words, known``: of every row the number of its words and, in order, the wanted ones with their places."""
    low = lower_ascii(F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = df.select(F.col(id).cast("long").alias("doc_id"), F.split(F.regexp_replace(low, f"^{GAP}", ""), GAP).alias("ws"))
    known = F.transform("ws", lambda w, at: F.when(w.isin(wanted), F.struct(at.cast("int").alias("at"), w.alias("w"))))
    # Only after the last gap a word may be empty.
    return rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        (F.size("ws") - (F.element_at("ws", -1) == "").cast("int")).cast("long").alias("n_words"),
        F.filter(known, lambda x: x.isNotNull()).alias("known"),
    )


def places(known: Column, phrases=PHRASES) -> Column:
    """``array<struct<at, label>>``: the places where a phrase's words stand one after the other."""

    def standing(ws: list[str], label: str) -> Column:
        def place(x: Column, j: Column) -> Column:
            following = [F.get(known, j + k) for k in range(1, len(ws))]
            stands = reduce(and_, [x["w"] == ws[0], *((y["w"] == w) & (y["at"] == x["at"] + k) for k, (y, w) in enumerate(zip(following, ws[1:]), 1))])
            return F.when(stands, F.struct(x["at"].cast("long").alias("at"), F.lit(label).alias("label")))

        return F.filter(F.transform(known, place), lambda p: p.isNotNull())

    return F.concat(*(standing(phrase.split(), label) for phrase, label in phrases))


def template_matches(rows: DataFrame, sets: list[Template]) -> DataFrame:
    """``row, label, share`` of every template that a block of ``rows(row, known)`` meets, the best block's share."""
    counted = rows.select(F.explode("known.w").alias("w")).groupBy("w").count()
    frequency = {r.w: r["count"] for r in counted.collect()}  # at most one row per word of the templates
    prefixes = []
    for t in sets:
        order = sorted(t.words, key=lambda w: (frequency.get(w, 0), w))
        prefixes += [(w, t.label, len(order), t.needed, t.block, t.name, order) for w in order[: len(order) - t.needed + 1]]
    probe = rows.sparkSession.createDataFrame(prefixes, "prefix string, label string, n int, a int, block int, name string, words array<string>")

    rare = sorted({p[0] for p in prefixes})
    places_of = F.filter(F.sequence(F.lit(1), F.size("known")), lambda j: F.get("known", j - 1)["w"].isin(rare))
    found = rows.where(F.exists("known", lambda x: x["w"].isin(rare))).select("row", "known", F.explode(places_of).alias("j"))
    found = found.withColumn("prefix", F.get("known", F.col("j") - 1)["w"]).join(F.broadcast(probe), "prefix")  # a row per prefix word
    at = F.get("known", F.col("j") - 1)["at"]
    first = F.greatest(F.col("j") - F.col("block") + 1, F.lit(1))  # no block has more known words than words
    near = F.slice("known", first, F.col("j") - first + F.col("block"))
    near = F.filter(near, lambda x: (x["at"] > at - F.col("block")) & (x["at"] < at + F.col("block")) & F.array_contains("words", x["w"]))
    found = found.select("row", "label", "n", "a", "block", "name", at.alias("at"), near.alias("near")).where(F.size("near") >= F.col("a"))

    def overlap(start: Column) -> Column:
        inside = F.transform(F.filter("near", lambda x: (x["at"] >= start) & (x["at"] < start + F.col("block"))), lambda x: x["w"])
        return F.when(F.col("name").isNull() | F.array_contains(inside, F.col("name")), F.size(F.array_distinct(inside))).otherwise(0)

    starts = F.transform(F.filter("near", lambda x: x["at"] <= F.col("at")), lambda x: x["at"])
    met = found.select("row", "label", "n", "a", F.array_max(F.transform(starts, overlap)).alias("overlap")).where("overlap >= a")
    return met.groupBy("row", "label").agg(F.max(F.col("overlap") / F.col("n")).alias("share"))


def scan(df: DataFrame, id: str = "doc_id", text: str = "text", templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is 1 where a phrase stands, else the largest share of a template in one block if it
    meets the threshold, else 0.  Labels are distinct, sorted and comma-joined, the empty string if there
    are none.  A null text is empty.  Rows without an id and repeated rows are scanned like others; only
    id and text are read.
    """
    sets = as_sets(templates, threshold)
    rows = written(known_words(df, id, text, vocabulary(sets)), "known")
    base = rows.select("row", "doc_id", "n_words", places(F.col("known")).alias("places"))
    base = base.select(
        "row",
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["at"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["at"])).alias("last_word"),
        F.array_distinct(F.transform("places", lambda p: p["label"])).alias("of_base"),
    )
    met = template_matches(rows.select("row", "known"), sets).groupBy("row").agg(F.collect_set("label").alias("of_templates"), F.max("share").alias("share"))
    joined = base.join(written(met, "licenses"), "row", "left")
    labels = F.array_union("of_base", F.coalesce("of_templates", F.array().cast("array<string>")))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("of_base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
