"""SentencePiece encoding and decoding by an Aho-Corasick automaton over the pieces.

The automaton reads a text once.  At each position its output links name every piece that ends there, and
each such piece relaxes the best score of the position: a Viterbi in a single pass.  No piece has a blank
mark behind another character, so a text falls apart before each run of marks, and
equal words are worked out once per task.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from logframe.llm.common import mapped, text_rows

MARK = "▁"
#: A run of blanks and the word behind it.
RUN = re.compile(" +[^ ]*")
#: What an unknown character costs more than the worst piece (fixed value).
UNKNOWN = 10.0
#: Words whose ids a Python worker keeps.
CACHED = 400_000
_codecs: dict[str, "Codec"] = {}


def model(name: str = "piece_bpe_32k.model") -> str:
    """The path of a public model."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Codec:
    """Encoding and decoding with the pieces and scores of a model file.

    The best segmentation has the largest sum of scores; of equal ones, the one whose last piece is
    longest, and so on from the end.  A character that is no piece costs ``UNKNOWN`` below the worst score
    and becomes its UTF-8 bytes.
    """

    def __init__(self, path: str) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes: dict[int, int] = {}
        self.unknown = sp.unk_id()
        self.written = [b""] * sp.get_piece_size()  # what each id decodes to
        self.automaton = ahocorasick.Automaton()
        scores = {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte = int(piece[3:-1], 16)
                self.bytes[byte], self.written[i] = i, bytes([byte])
            elif sp.is_unknown(i):
                self.written[i] = "\ufffd".encode()
            elif not (sp.is_control(i) or sp.is_unused(i)):
                scores[piece] = sp.get_score(i)
                self.automaton.add_word(piece, (len(piece), i, scores[piece]))
                self.written[i] = piece.replace(MARK, " ").encode()
        self.automaton.make_automaton()
        self.worst = min(scores.values(), default=0.0) - UNKNOWN
        self.known = {piece for piece in scores if len(piece) == 1}
        self.apart = not any(MARK in piece.lstrip(MARK) for piece in scores)
        self.words: dict[str, bytes] = {}

    def best(self, text: str) -> list[int]:
        """The ids of the best segmentation of a text with its marks."""
        if not self.known.issuperset(text):
            return self._best_with_unknown(text)
        n = len(text)
        total, size_at, id_at = [0.0] + [-math.inf] * n, [0] * (n + 1), [0] * (n + 1)
        for end, (size, i, score) in self.automaton.iter(text):  # of pieces with the same end, the longest first
            end += 1
            new = total[end - size] + score
            if new > total[end]:
                total[end], size_at[end], id_at[end] = new, size, i
        ids: list[int] = []
        while n:
            ids.append(id_at[n])
            n -= size_at[n]
        return ids[::-1]

    def _best_with_unknown(self, text: str) -> list[int]:
        n = len(text)
        total, back = [0.0] + [-math.inf] * n, [(1, None)] * (n + 1)
        done = 0  # positions up to here are settled

        def settle(upto: int) -> None:
            nonlocal done
            for at in range(done + 1, upto + 1):
                cost = total[at - 1] + self.worst
                if text[at - 1] not in self.known and cost > total[at]:
                    total[at], back[at] = cost, (1, None)
            done = upto

        for end, (size, i, score) in self.automaton.iter(text):
            settle(end)
            new = total[end + 1 - size] + score
            if new > total[end + 1]:
                total[end + 1], back[end + 1] = new, (size, i)
        settle(n)
        ids: list[int] = []
        while n:
            size, i = back[n]
            ids += [i] if i is not None else [self.bytes.get(b, self.unknown) for b in reversed(text[n - 1].encode())]
            n -= size
        return ids[::-1]

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, which gets a blank in front; blanks become marks."""
        if not text:
            return np.zeros(0, "<u4")
        if MARK in text or not self.apart:
            return np.array(self.best(MARK + text.replace(" ", MARK)), "<u4")
        words = text.split(" ")
        if "" in words:  # blanks in a row belong to the word behind them
            words = [w[1:] for w in RUN.findall(" " + text)]
        cache = self.words
        if len(cache) > CACHED:
            cache.clear()
        for word in set(words).difference(cache):
            cache[word] = array("I", self.best(MARK + word.replace(" ", MARK))).tobytes()
        return np.frombuffer(b"".join(map(cache.__getitem__, words)), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the blank in front goes."""
        return b"".join(map(self.written.__getitem__, ids.tolist())).decode("utf-8", "replace").removeprefix(" ")


def codec(path: str) -> Codec:
    """The codec of this Python worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encoded(df: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id, ids`` (array of int) of every row.  A null text has null ids, an empty one none.

    Rows without an id and repeated rows are encoded like others; other columns are not read.
    """
    path = path or model()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = codec(path)
        for ids, texts in text_rows(batches):
            found = [None if t is None else of.encode(t).astype(np.int32) for t in texts]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = df.select(F.col(id).cast("long"), F.col(text).cast("string"))
    return rows.transform(mapped, encode, "doc_id long, ids array<int>")


def decoded(df: DataFrame, id: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """``doc_id, text`` of every row of ids; null ids give a null text."""
    path = path or model()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = codec(path)
        for batch in batches:
            texts = [None if x is None else of.decode(np.array(x, np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = df.select(F.col(id).cast("long").alias("doc_id"), F.col(ids).cast("array<int>"))
    return rows.transform(mapped, decode, "doc_id long, text string")


def digests(df: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id, n_ids, ids_crc32, decoded_crc32, round_trip`` of every row.

    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit numbers, ``decoded_crc32`` over the UTF-8
    bytes of the text decoded from them, and ``round_trip`` says that it is the text.  A null text counts as empty.
    """
    path = path or model()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = codec(path)
        for ids, texts in text_rows(batches):
            rows = []
            for key, value in zip(ids, texts):
                found = of.encode(value or "")
                back = of.decode(found)
                rows.append((key, len(found), zlib.crc32(found.astype("<u4").tobytes()), zlib.crc32(back.encode()), back == (value or "")))
            kinds = [pa.int64()] * 4 + [pa.bool_()]
            names = ["doc_id", "n_ids", "ids_crc32", "decoded_crc32", "round_trip"]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    rows = df.select(F.col(id).cast("long"), F.col(text).cast("string"))
    return rows.transform(mapped, work, "doc_id long, n_ids long, ids_crc32 long, decoded_crc32 long, round_trip boolean")
