"""SentencePiece BPE by a merge-type prefix table, and its decoding.

For every prefix of a text the last token of the prefix's encoding is unique. An automaton gives the
pieces that end at a position; a piece is the last token if it is compatible with the last token of
the prefix before it, that is, if merging their two texts gives these two tokens and no others. The
table is filled from left to right and the ids are recovered backwards from its end.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, SparkSession, functions as F

from dragoman.llm.common import kept

SPACE = "▁"
#: Words, and pairs of tokens, whose result a worker keeps at most. Words not seen while half of them came are let go;
#: pairs are filled anew beyond it.
KEPT_WORDS, KEPT_PAIRS = 400_000, 500_000
#: Characters of a kept word at most, so that what a worker keeps is bounded in bytes for unspaced text too.
KEPT_CHARS = 40

#: Characters of the texts whose ids and decoded texts a worker hands on at once, or one text.
PART_CHARS = 1 << 20

#: Ids as little-endian unsigned 32-bit integers, by their number.
_U4 = [struct.Struct(f"<{n}I") for n in range(KEPT_CHARS)]

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


def model_bytes(path: str) -> bytes:
    """The model file, read on the driver; a vocabulary's size is fixed, so the bytes may be broadcast."""
    with open(path, "rb") as file:
        return file.read()


class Words(dict):
    """Encoded words, computed on first use; long ones are computed each time.

    The words of the generation before are kept beside: one that is met again moves over, the others go with the next change.
    """

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode, self.before = encode, {}

    def __missing__(self, word: str) -> bytes:
        got = self.before.get(word)
        if got is None:
            got = self.encode(word)
            if len(word) >= KEPT_CHARS:
                return got
        self[word] = got
        return got

    def aged(self) -> None:
        """Starts a new generation when this one has its share of words."""
        if len(self) > KEPT_WORDS // 2:
            self.before = dict(self)
            self.clear()


class Pieces:
    """Encoder and decoder of a BPE model with byte fallback, identity normalisation and a dummy prefix."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(sp.vocab_size())
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        special = {k for k in ids if sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k)}
        if any(sp.is_unused(k) for k in ids) or sp.normalize("ﬁ  x") != f"{SPACE}ﬁ{SPACE * 2}x":
            raise ValueError("unused pieces and normalising models are not supported")
        self.piece = [sp.id_to_piece(k) for k in ids]
        self.id = {self.piece[k]: k for k in ids if k not in special}
        self.score = {p: sp.get_score(k) for p, k in self.id.items()}
        self.byte = {int(self.piece[k][3:5], 16): k for k in special if sp.is_byte(k)}
        #: no piece goes on over the start of a word, so words are encoded one by one
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.id)
        self.surface = [p.replace(SPACE, " ").encode() for p in self.piece]
        for k in special:
            self.surface[k] = " ⁇ ".encode() if k == self.unk else b""
        for value, k in self.byte.items():
            self.surface[k] = bytes([value])
        self.ends = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for p, k in self.id.items():
            self.ends.add_word(p, k)
        self.ends.make_automaton()
        self.size = [len(p) for p in self.piece]
        self.pairs: dict[int, bool] = {}  # by left * pieces + right
        self.own: dict[int, bool] = {}
        self.words = Words(lambda word: self._pack(SPACE + word))

    def merged(self, text: str) -> list[str]:
        """The definition: merge the adjacent pair of the best score, the leftmost of equals, until none is left."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _is_own(self, token: int) -> bool:
        if token not in self.own:
            self.own[token] = self.merged(self.piece[token]) == [self.piece[token]]
        return self.own[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens stand next to each other in an encoding; kept for the next time."""
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        a, b = self.piece[left], self.piece[right]
        got = self.pairs[left * len(self.piece) + right] = self._is_own(right) and self.merged(a + b) == [a, b]
        return got

    def table(self, text: str) -> list[int]:
        """At k the last token of the encoding of text[:k + 1]; -1 for a character without a piece."""
        last, size, known, own, at = [-1] * len(text), self.size, self.pairs.get, self.own.get, -1
        n = len(size)
        for end, token in self.ends.iter(text):
            if end == at:
                continue  # the longer piece that ends here was the one
            before = end - size[token]
            left = last[before] if before >= 0 else -1
            if left < 0:
                fits = own(token)
                if fits is None:
                    fits = self._is_own(token)
            else:
                fits = known(left * n + token)
                if fits is None:
                    fits = self.compatible(left, token)
            if fits:
                last[end], at = token, end
        return last

    def _pack(self, text: str) -> bytes:
        last, out, k, size = self.table(text), [], len(text) - 1, self.size
        while k >= 0:
            token = last[k]
            if token < 0:
                out.extend(self.byte.get(b, self.unk) for b in reversed(text[k].encode()))
                k -= 1
            else:
                out.append(token)
                k -= size[token]
        out.reverse()
        return _U4[len(out)].pack(*out) if len(out) < len(_U4) else np.array(out, "<u4").tobytes()

    def encode(self, text: str | None, add_ends: bool = True) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        ends = [np.array([k], "<u4").tobytes() if add_ends else b"" for k in (self.bos, self.eos)]
        if not text:
            return b"".join(ends)
        self.words.aged()
        words = text.split(" ")
        if not self.by_word:
            body = self._pack(SPACE + text.replace(" ", SPACE))
        elif SPACE in text or "" in words:
            body = b"".join(self.words[w[1:]] if w[1:2] != SPACE else self._pack(w)
                            for w in re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE)))
        else:
            body = b"".join([self.words[w] for w in words])
        return ends[0] + body + ends[1]

    def decode(self, ids: bytes | None) -> str:
        """Text of ids; control tokens vanish, each byte that is no UTF-8 becomes U+FFFD."""
        surface = self.surface
        text = b"".join([surface[k] for k in np.frombuffer(ids or b"", "<u4").tolist()]).decode("utf-8", "each_byte")
        return text[1:] if text[:1] == " " else text


def coder_of(model: bytes) -> Pieces:
    """The coder of a model; a worker keeps one, and its words and pairs, from task to task."""
    return kept(("pieces", model), lambda: Pieces(model))


def _parts(texts: pd.Series) -> Iterator[list[str | None]]:
    """The texts in order, as many at once as PART_CHARS characters hold, or one."""
    part, held = [], 0
    for text in texts:
        if part and held + len(text or "") > PART_CHARS:
            yield part
            part, held = [], 0
        part.append(text)
        held += len(text or "")
    if part or not len(texts):
        yield part


def round_trip(spark: SparkSession, text: Column, model_path: str) -> Column:
    """Struct (ids binary, decoded string) of whole texts, with begin and end ids.

    ``ids`` holds little-endian unsigned 32-bit integers. Null and empty texts give the begin and end
    ids alone and an empty decoded text. Every row is encoded by itself: order, ties, repeated rows
    and other columns do not matter.
    """
    model = spark.sparkContext.broadcast(model_bytes(model_path))

    @F.pandas_udf("ids binary, decoded string")
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = coder_of(model.value)
        for texts in batches:
            for part in _parts(texts):  # results are several times a batch
                ids = [coder.encode(t) for t in part]
                yield pd.DataFrame({"ids": ids, "decoded": [coder.decode(x) for x in ids]})
    return pieces(text)
