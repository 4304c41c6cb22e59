"""Benchmark decontamination by the q-gram lemma.

A passage within e edits of an item of n characters shares at least n - q + 1 - q * e q-grams with it,
on diagonals at most e apart. Shared q-grams are counted in bands of diagonals that overlap by half, so
each such passage lies in one band whole; bands that reach the bound are verified by banded alignment.
Short items, which chance edits would turn into other phrases, are found by equality with an automaton.
The benchmark is a stated query set: it is cut into blocks of a fixed size, and each block's index is
broadcast to a pass over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from dragoman.llm.common import bound_batches, col

Q = 12
#: Edits allowed for each character of an item; below 1 / Q, so that the bound stays above zero.
EDIT_RATE = 0.05
#: Items of fewer normalised characters are found by equality, between borders of words.
MIN_ITEM_CHARS = 40
#: Normalised benchmark characters of one block; bounds the broadcast index (about 40 bytes each).
BLOCK_CHARS = 1 << 20

_LOWER = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in range(0x10000)], np.uint32)
_SPACE = np.array([chr(c).isspace() for c in range(0x10000)])


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(code points in lower case with runs of white space as one space, their places in ``text``)."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    low = np.minimum(points, 0xFFFF)
    points = np.where(points < 0x10000, _LOWER[low], points)
    space = (points < 0x10000) & _SPACE[low]
    keep = ~space | np.r_[True, ~space[:-1]]
    places = np.flatnonzero(keep)
    return np.where(space, 32, points)[places].astype(np.uint32), places


def trimmed(text: str) -> np.ndarray:
    return normalised(text.strip())[0]


def string_of(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def inside_word(text: str, at: int) -> bool:
    """Whether the place before character ``at`` lies between two characters of a word."""
    return 0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum()


def gram_hashes(points: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of each q-gram, joined from hashes of powers of two."""
    base, size, at = points.astype(np.uint64) + np.uint64(1), 1, 0
    out, width = None, 0
    factor = 0x9E3779B97F4A7C15
    with np.errstate(over="ignore"):
        while True:
            if q & size:
                if out is None:
                    out, width = base, size
                else:
                    n = len(points) - width - size + 1
                    out = out[:max(n, 0)] * np.uint64(pow(factor, size, 1 << 64)) + base[width:width + max(n, 0)]
                    width += size
            if 2 * size > q:
                return out[:max(len(points) - q + 1, 0)]
            base = base[:-size] * np.uint64(pow(factor, size, 1 << 64)) + base[size:] if len(base) > size else base[:0]
            size *= 2


class Index:
    """Q-grams of a block of items."""

    def __init__(self, items: list[tuple[int, str]], q: int, rate: float):
        self.q = q
        points = [(i, trimmed(t)) for i, t in items]
        self.items = [(i, p) for i, p in points if len(p) >= max(MIN_ITEM_CHARS, q)]
        short: dict[str, list[int]] = {}
        for i, p in points:
            if 0 < len(p) < max(MIN_ITEM_CHARS, q):
                short.setdefault(string_of(p), []).append(i)
        self.short = ahocorasick.Automaton() if short else None
        for text, ids in short.items():
            self.short.add_word(text, (len(text), ids))
        if short:
            self.short.make_automaton()
        self.edits = np.array([int(rate * len(p)) for _, p in self.items], np.int64)
        sizes = np.array([len(p) for _, p in self.items], np.int64)
        self.bound = sizes - q + 1 - q * self.edits
        grams = [gram_hashes(p, q) for _, p in self.items]
        self.hash = np.concatenate([*grams, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, np.int64)])
        order = np.argsort(self.hash, kind="stable")
        self.hash, self.owner, self.place = self.hash[order], owner[order], place[order]
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.hash >> np.uint64(42)).astype(np.int64)] = True

    def regions(self, points: np.ndarray) -> list[tuple[int, int]]:
        """(item, first diagonal of the band) where the bands' counts reach the bound."""
        hashes = gram_hashes(points, self.q)
        at = np.flatnonzero(self.bits[(hashes >> np.uint64(42)).astype(np.int64)])
        if not len(at):
            return []
        low, high = np.searchsorted(self.hash, hashes[at]), np.searchsorted(self.hash, hashes[at], "right")
        n = high - low
        if not n.sum():
            return []
        posting = np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        item = self.owner[posting]
        diagonal = np.repeat(at, n) - self.place[posting] + (1 << 24)  # items are shorter than a block
        step = self.edits[item] + 1
        band = diagonal // step
        key = np.concatenate([item << 40 | band, item << 40 | band - 1])  # a band is two steps wide
        # one q-gram of the item counts once in a band, however often a repetitive text has it
        pair = np.unique(np.stack([key, np.concatenate([self.place[posting]] * 2)], axis=1), axis=0)[:, 0] if len(key) else key
        unique, count = np.unique(pair, return_counts=True)
        item = unique >> 40
        good = count >= self.bound[item]
        return [(int(i), int(b * (self.edits[i] + 1)) - (1 << 24)) for i, b in zip(item[good], (unique & ((1 << 40) - 1))[good])]

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, start, end, edits) of each item's best passage in ``text``, in its code points."""
        points, places = normalised(text)
        best: dict[int, tuple[int, int, int]] = {}
        for item, diagonal in self.regions(points):
            if best.get(item, (1,))[0] == 0:
                continue  # an equal passage further left is known
            width, edits = 2 * int(self.edits[item]) + 2, int(self.edits[item])
            got = equal(self.items[item][1], points, diagonal, width) or align(self.items[item][1], points, diagonal, width, edits)
            if got and (item not in best or got < best[item]):
                best[item] = got
        found = [(self.items[i][0], int(places[s]), int(places[e - 1]) + 1, d) for i, (d, s, e) in sorted(best.items())]
        return found + [(i, int(places[s]), int(places[e - 1]) + 1, 0) for i, (s, e) in self.short_items(points)]

    def short_items(self, points: np.ndarray) -> list[tuple[int, tuple[int, int]]]:
        """(item_id, (start, end)): the leftmost passage between borders of words that equals each short item."""
        if self.short is None:
            return []
        text, first = string_of(points), {}
        for end, (size, ids) in self.short.iter(text):
            start = end + 1 - size
            if ids[0] not in first and not inside_word(text, start) and not inside_word(text, end + 1):
                first.update((i, (start, end + 1)) for i in ids)
        return sorted(first.items())


def equal(item: np.ndarray, text: np.ndarray, diagonal: int, width: int) -> tuple[int, int, int] | None:
    """The leftmost passage on these diagonals that equals ``item``."""
    for start in range(max(diagonal, 0), min(diagonal + width, len(text) - len(item)) + 1):
        if text[start] == item[0] and np.array_equal(text[start:start + len(item)], item):
            return 0, start, start + len(item)
    return None


def align(item: np.ndarray, text: np.ndarray, diagonal: int, width: int, edits: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the passage of ``text`` closest to the whole ``item`` on the diagonals
    from ``diagonal`` to ``diagonal + width``, if within ``edits``; the leftmost of equals."""
    # one more edit may lead one diagonal off the band and back
    lo = diagonal - edits
    cells = width + 2 * edits + 1
    far = len(item) + len(text) + 1
    column = np.arange(cells)
    start = lo + column                       # text position before the first character, by diagonal
    inside = (start >= 0) & (start <= len(text))
    cost = np.where(inside, 0, far)
    origin = np.where(inside, start, 0)
    padded = np.concatenate([text, np.array([0xFFFFFFFF], np.uint32)])
    for i, c in enumerate(item, 1):
        j = lo + i + column                   # text position after this row, by diagonal
        valid = (j >= 0) & (j <= len(text))
        char = padded[np.clip(j - 1, -1, len(text))]
        swap = np.where(valid & (j >= 1), cost + (char != c), far)
        drop = np.r_[cost[1:], far] + 1       # the item's character is missing in the text
        now = np.where(drop < swap, drop, swap)
        begun = np.where(drop < swap, np.r_[origin[1:], 0], origin)
        now = np.where(valid, now, far)
        # characters only the text has: a running minimum along the row
        run = np.minimum.accumulate(now - column)
        shorter = run + column < now
        if shorter.any():
            holder = np.maximum.accumulate(np.where(now - column == run, column, -1))
            begun = np.where(shorter, begun[holder], begun)
            now = np.where(valid, np.minimum(now, run + column), far)
        cost, origin = now, begun
        if cost.min() > edits:
            return None
    k = int(np.argmin(cost))
    end = lo + len(item) + k
    return (int(cost[k]), int(origin[k]), end) if cost[k] <= edits and end > origin[k] else None


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, streamed to the driver one partition at a time."""
    block, held = [], 0
    rows = items.select(col(id_col), col(text_col)).filter(col(id_col).isNotNull() & col(text_col).isNotNull()).distinct()
    for row in rows.toLocalIterator():
        block.append((row[0], row[1]))
        held += len(row[1])
        if held >= block_chars:
            yield block
            block, held = [], 0
    if block:
        yield block


def leaks(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text", q: int = Q, edit_rate: float = EDIT_RATE,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, start, end, edits): for each row of ``docs`` and each item that it holds, the best passage.

    Case and runs of white space do not count. Offsets are code points of the row's text, the end is
    exclusive. Items of fewer than ``MIN_ITEM_CHARS`` characters are found where a passage between borders of
    words equals them. Null texts, null ids of items, and items without a character give no row; a row of ``docs`` without an id keeps a null id. Repeated rows stay repeated.
    """
    if edit_rate >= 1 / q:
        raise ValueError("edit_rate must be below 1 / q")
    bound_batches(spark)
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text")).filter("text is not null")
    schema = "doc_id long, item_id long, start int, end int, edits int"
    names = ["doc_id", "item_id", "start", "end", "edits"]
    out = None
    for block in item_blocks(items, item_id, item_text, block_chars):
        index = spark.sparkContext.broadcast(Index(block, q, edit_rate))

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(doc, *hit) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                         for hit in index.value.search(text)]
                columns = list(zip(*found)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 2 + [pa.int32()] * 3)], names)
        part = rows.mapInArrow(search, schema)
        out = part if out is None else out.union(part)
    return spark.createDataFrame([], schema) if out is None else out


def clean(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose id holds a benchmark item; rows without an id are judged by their text alone."""
    key = F.coalesce(col(id_col).cast("string"), F.concat(F.lit("\0"), F.sha2(col(text_col), 256)))
    marked = docs.select(F.xxhash64(key).alias("doc_id"), col(text_col).alias("text"))
    found = leaks(spark, marked, items, **options).select(F.col("doc_id").alias("_leaked")).distinct()
    return docs.join(found, F.xxhash64(key) == F.col("_leaked"), "left_anti")
