"""Language ID against a plain version: dictionaries of n-grams, loops over pairs."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np

from logframe.llm import langid
from tests.llm.test_operators import docs

WORDS = {"en": "the and with from that", "de": "der und mit von dass", "fr": "le et avec dans que", "es": "el y con desde que", "ru": "и не что на я", "xx": "zzq qqz zqz"}


def plain_features(text):
    low, counts = " " + " ".join(text.lower().split()) + " ", Counter()
    for n in range(1, 4):
        for i in range(len(low) - n + 1):
            h = 0
            for c in low[i : i + n]:
                h = (h * 1_000_003 + ord(c)) % 2**64
            counts[(h + n) * 0x9E3779B97F4A7C15 % 2**64 >> 51] += 1
    length = math.sqrt(sum(counts.values()))
    return {k: math.sqrt(v) / length for k, v in counts.items()}


def plain_separator(rows, y, regular=1e-4, rounds=12):
    """Weights by bin (-1: the bias), one row at a time."""
    up, down = sum(v > 0 for v in y), sum(v < 0 for v in y)
    w, mean, steps, kept, order = {}, {}, 0, 0, np.random.default_rng(7)
    for turn in range(rounds):
        for at in np.array_split(order.permutation(len(rows)), max(1, len(rows) // 16)):
            steps += 1
            rate = 1 / (regular * (steps + 1000))
            wrong = [k for k in at if y[k] * sum(w.get(b, 0.0) * x for b, x in rows[k].items()) < 1]
            w = {b: v * (1 - rate * regular) for b, v in w.items()}
            for k in wrong:
                weight = len(y) / (2 * max(up if y[k] > 0 else down, 1))
                for b, x in rows[k].items():
                    w[b] = w.get(b, 0.0) + rate / len(at) * weight * y[k] * x
            if turn >= rounds // 2:
                kept += 1
                mean = {b: mean.get(b, 0.0) + (w.get(b, 0.0) - mean.get(b, 0.0)) / kept for b in w.keys() | mean.keys()}
    return mean


def plain_votes(rows, labels):
    classes = sorted(set(labels))
    machines = {}
    for i, a in enumerate(classes):
        for b in classes[i + 1 :]:
            of = [k for k, v in enumerate(labels) if v in (a, b)]
            machines[a, b] = plain_separator([rows[k] for k in of], [1.0 if labels[k] == b else -1.0 for k in of])

    def vote(x):
        won, total, least = Counter(), Counter(), dict.fromkeys(classes, 1.0)
        for (a, b), w in machines.items():
            margin = sum(w.get(k, 0.0) * v for k, v in x.items()) + w.get(-1, 0.0)
            sure = 1 / (1 + math.exp(-4 * margin))
            won[b if margin > 0 else a] += 1
            total[a] -= margin
            total[b] += margin
            least[a], least[b] = min(least[a], 1 - sure), min(least[b], sure)
        best = max(classes, key=lambda c: (won[c], total[c], [-ord(d) for d in c]))
        return best, least[best]

    return vote


def plain_model(rows):
    x = [plain_features(t) | {-1: 1.0} for t, _ in rows]
    kin = [langid.family(v) for _, v in rows]
    top = plain_votes(x, kin)
    within = {f: plain_votes([x[k] for k, g in enumerate(kin) if g == f], [v for (_, v), g in zip(rows, kin) if g == f]) for f in set(kin)}

    def predict(text):
        if not text or not any(map(str.isalpha, text)):
            return "und", 0.0
        own = plain_features(text)
        f, sure = top(own)
        language, inner = within[f](own)
        return language, min(1.0, max(0.0, sure * inner))

    return predict


def test_predictions_equal_a_plain_version(spark):
    drawn = random.Random(4)
    texts, langs = [], []
    for k in range(90):
        lang = drawn.choice(list(WORDS))
        texts.append(" ".join(drawn.choice(WORDS[lang].split()) for _ in range(drawn.randrange(1, 12))))
        langs.append(lang if k % 9 else None)
    texts += ["", None, "12 !", "the y und", "Zzq THE"]
    langs += ["en", "de", "fr", None, "xx"]
    table = docs(spark, texts, lang=langs)
    learned = [(zlib.crc32(str(k).encode()), t, v) for k, (t, v) in enumerate(zip(texts, langs)) if t and v and any(map(str.isalpha, t)) and zlib.crc32(str(k).encode()) % 4 != 2]
    model = langid.train(table)
    rank = {r.id: r.h for r in table.selectExpr("doc_id AS id", f"pmod(xxhash64(cast(doc_id AS string), 17), {1 << 40}) AS h").collect()}
    order = sorted((v, rank[k], t) for k, (t, v) in enumerate(zip(texts, langs)) if (zlib.crc32(str(k).encode()), t, v) in learned)
    predict = plain_model([(t, v) for v, _, t in order])
    got = {r.doc_id: r for r in langid.identify(table, model).collect()}
    for k, text in enumerate(texts):
        want, score = predict(text)
        assert got[k].lang_pred == want and abs(got[k].score - score) < 1e-3, (text, got[k], want, score)


def test_only_the_languages_with_most_rows_are_learned(spark):
    texts = [f"{WORDS['en']} {k}" for k in range(60)] + [f"{WORDS['de']} {k}" for k in range(50)] + [f"q{k} w{k}" for k in range(40)]
    table = docs(spark, texts, lang=["en"] * 60 + ["de"] * 50 + [f"l{k}" for k in range(40)])
    model = langid.train(table, languages=2)
    assert set(model.top.classes) == {"germanic"} and model.within["germanic"].classes == ["de", "en"]
