"""Language identification in two steps: the language family, then the language within it.

Features are counts of character 1- to 3-grams, hashed into ``DIM`` bins and scaled to length one.
The first step tells the families apart, the second the languages of the family found; both are
one-versus-one linear support vector machines that vote.
"""

from __future__ import annotations

import itertools
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logframe.llm.common import mapped, text_rows

DIM = 1 << 13
#: Families of languages (fixed values); a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr"),
}
UNDETERMINED = "und"
#: Below this score a text is unsure.  Of the given clean texts those below it are short and nearly all letters.
UNSURE = 0.6


def family(language: str) -> str:
    """The family of a language."""
    return next((f for f, known in FAMILIES.items() if language in known), language)


def has_letter(text: str | None) -> bool:
    """Whether a text has a letter of any script."""
    return bool(text) and any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """The hashed n-gram counts of a whole text, blanks and digits joined, scaled to length one."""
    low = " " + " ".join(text.lower().split()) + " "
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    grams = codes
    counts = np.zeros(DIM)
    for n in range(1, 4):
        if n > 1:
            grams = grams[:-1] * np.uint64(1_000_003) + codes[n - 1 :]
        mixed = (grams + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        counts += np.bincount((mixed >> np.uint64(64 - 13)).astype(np.int64), minlength=DIM)
    counts = np.sqrt(counts)
    return (counts / (np.linalg.norm(counts) or 1.0)).astype(np.float32)


def separator(x: np.ndarray, rows: np.ndarray, y: np.ndarray, regular: float = 1e-4, rounds: int = 12) -> np.ndarray:
    """Weights of a linear support vector machine for labels -1 and 1 of some rows of ``x``, by subgradient steps.

    The last column of ``x`` is 1 and carries the bias.  The steps take the rows in a fixed shuffled
    order, so equal input gives equal weights.  Classes of different size weigh the same.
    """
    weight = np.where(y > 0, len(y) / (2 * max((y > 0).sum(), 1)), len(y) / (2 * max((y < 0).sum(), 1)))
    w, mean, steps, kept = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0, 0
    order = np.random.default_rng(7)
    for turn in range(rounds):
        for at in np.array_split(order.permutation(len(rows)), max(1, len(rows) // 16)):
            steps += 1
            rate = 1 / (regular * (steps + 1000))
            part = x[rows[at]]
            hinge = y[at] * (part @ w) < 1
            w *= 1 - rate * regular
            if hinge.any():
                w += rate / len(at) * ((weight[at] * y[at])[hinge] @ part[hinge])
            if turn >= rounds // 2:
                kept += 1
                mean += (w - mean) / kept
    return mean


class Votes:
    """One-versus-one machines over the classes of some rows of ``x``."""

    def __init__(self, x: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> None:
        self.classes = sorted(set(labels[rows].tolist()))
        self.pairs = list(itertools.combinations(range(len(self.classes)), 2))
        self.weights = np.zeros((len(self.pairs), x.shape[1]), np.float32)
        for k, (i, j) in enumerate(self.pairs):
            of = rows[np.isin(labels[rows], (self.classes[i], self.classes[j]))]
            self.weights[k] = separator(x, of, np.where(labels[of] == self.classes[j], 1.0, -1.0))

    def __call__(self, x: np.ndarray) -> tuple[str, float]:
        """The class with most votes (ties: the larger sum of margins, then the first), and its confidence."""
        if not self.pairs:
            return self.classes[0], 1.0
        margins = self.weights[:, :-1] @ x + self.weights[:, -1]
        sure = 1 / (1 + np.exp(-4 * margins))
        won, total = np.zeros(len(self.classes)), np.zeros(len(self.classes))
        least = np.ones(len(self.classes))
        for (i, j), m, s in zip(self.pairs, margins, sure):
            won[j if m > 0 else i] += 1
            total[i] -= m
            total[j] += m
            least[i], least[j] = min(least[i], 1 - s), min(least[j], s)
        best = max(range(len(won)), key=lambda c: (won[c], total[c], -c))
        return self.classes[best], float(least[best])


class Model:
    """The family step and, per family, the language step."""

    def __init__(self, x: np.ndarray, languages: np.ndarray) -> None:
        families = np.array([family(v) for v in languages.tolist()], object)
        self.top = Votes(x, np.arange(len(x)), families)
        self.within = {f: Votes(x, np.flatnonzero(families == f), languages) for f in self.top.classes}

    def __call__(self, text: str | None) -> tuple[str, float]:
        """The language of a text and a score from 0 to 1."""
        if not has_letter(text):
            return UNDETERMINED, 0.0
        x = features(text)
        kin, sure = self.top(x)
        language, inner = self.within[kin](x)
        return language, min(1.0, max(0.0, sure * inner))


def held_out(id) -> F.Column:
    """Whether a row's id puts it outside the training rows; a null id is not held out but never learned from."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(df: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 500, languages: int = 60) -> Model | None:
    """A model from at most ``per_language`` rows of each language, or ``None`` if there are none to learn from.

    The ``languages`` with most rows are learned (ties: the first by name): machines are as many as pairs of them.

    The rows come from those that are not held out and have id, language, and a text with a letter.
    Of each language, those with the smallest hashes are taken; the languages are counted over all rows
    first, so that about as many rows as needed leave the tasks, as sparse feature vectors of bounded size.
    """
    rows = df.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"), held_out(id).alias("out"))
    rows = rows.where("not out and id is not null and lang is not null and text is not null")
    common = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    counts = {r.lang: r.n for r in common.collect()}
    if not counts:
        return None
    # a share of each language that holds per_language rows or more but for chance; the rest is cut below
    share = F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(min(1.0, (per_language + 4 * per_language**0.5) / n))) for k, n in counts.items()))
    spread = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(17)), F.lit(1 << 40))
    taken = rows.withColumn("spread", spread).where(F.col("spread") < share[F.col("lang")] * (1 << 40))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for s, v, t in zip(*(c.to_pylist() for c in batch.columns)):
                if has_letter(t):
                    x = features(t)
                    bins = np.flatnonzero(x)
                    kept.append((s, v, bins.astype(np.uint16).tobytes(), x[bins].tobytes()))
            columns = list(zip(*kept)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.string(), pa.binary(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["spread", "lang", "bins", "x"])

    found = taken.select("spread", "lang", "text").transform(mapped, vectors, "spread long, lang string, bins binary, x binary")
    by_language: dict[str, list[tuple[int, bytes, bytes]]] = {}
    for r in found.collect():
        by_language.setdefault(r.lang, []).append((r.spread, bytes(r.bins), bytes(r.x)))
    chosen = [(v, *x) for v in sorted(by_language) for _, *x in sorted(by_language[v])[:per_language]]
    if not chosen:
        return None
    x = np.zeros((len(chosen), DIM + 1), np.float32)
    x[:, DIM] = 1  # for the bias
    for k, (_, bins, values) in enumerate(chosen):
        x[k, np.frombuffer(bins, np.uint16)] = np.frombuffer(values, np.float32)
    return Model(x, np.array([v for v, *_ in chosen], object))


def identify(df: DataFrame, model: Model | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, from its whole text alone.

    A text that is null, empty or without a letter is ``und`` with score 0, and so is every text where
    nothing could be learned.  Repeated rows are repeated; other columns are not read.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)  # fixed size: DIM weights per pair of classes

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sent.value or (lambda text: (UNDETERMINED, 0.0))
        for ids, texts in text_rows(batches):
            said = [found(t) for t in texts]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = df.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string"))
    said = rows.transform(mapped, predict, "doc_id long, lang_pred string, score double")
    return said.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def mostly_letters(text: str) -> bool:
    """Whether at least half of the characters other than white space are letters, or marks on letters."""
    seen = [c for c in text if not c.isspace()]
    return 2 * sum(c.isalpha() or unicodedata.category(c)[0] == "M" for c in seen) >= len(seen)


def to_keep(model: Model | None, text: str | None) -> bool:
    """Whether a text counts as language: it has a letter, and its language is sure or most of it is letters.

    A low score alone rejects nothing, as a language that was not learned has one too.  Without a model
    nothing can be unsure, and every text with a letter stays.
    """
    if not has_letter(text):
        return False
    return model is None or model(text)[1] >= UNSURE or mostly_letters(text)


def keep_identified(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of ``df``, with all their columns, whose text is to keep."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([to_keep(sent.value, t.as_py()) for t in batch.column(text)], pa.bool_()))

    return df.transform(mapped, keep, df.schema)
