"""Language identification by prediction by partial matching.

Each language has a byte context tree of orders 0 to K with escape method C and exclusion, frozen
after training. The exact code length of a byte after its K bytes of context depends on these K + 1
bytes only, so the lengths of all grams seen in training are tabulated for all languages at once,
and an unseen gram is scored by walking down the contexts, once per distinct gram of a block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dragoman.llm.common import bound_batches, col, kept, let_go

ORDER = 4
#: Training texts per language, about: the bound on the sample that the trees are fitted on.
ROWS_PER_LANGUAGE = 300
MAX_LANGUAGES = 1000
#: Bytes of a block; longer texts make parts that share their context.
BLOCK_BYTES = 1 << 20
#: Texts are scored together up to so many bytes, and so many of their grams are looked up at once.
SCORED_BYTES, PART_GRAMS = 1 << 19, 1 << 16
LETTER = re.compile(r"[^\W\d_]")
UNDETERMINED = "und"


def grams(block: np.ndarray, order: int) -> np.ndarray:
    """For every byte the number made of its ``order`` bytes of context and itself; block holds uint8."""
    out = np.zeros(len(block), "<i8")
    places = out.view(np.uint8).reshape(len(block), 8)
    for k in range(order + 1):
        places[k:, k] = block[:len(block) - k]
    return out


def blocks(texts: list[str | None], order: int, size: int = BLOCK_BYTES, enough: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(gram of every byte, number of its text), a block at a time; a text starts after ``order`` line feeds.

    Texts are cut at ``size`` bytes; a block ends with the part that fills ``size`` or ``enough`` bytes.
    """
    parts, owner, held = [], [], 0
    for k, text in enumerate(texts):
        data = b"\n" * order + (text or "").encode("utf-8")
        for start in range(order, len(data), size):
            part = data[start - order:start + size]
            parts.append(part)
            owner.append((k, len(part)))
            held += len(part)
            if held >= min(size, enough):
                yield _block(parts, owner, order)
                parts, owner, held = [], [], 0
    if parts:
        yield _block(parts, owner, order)


def _block(parts: list[bytes], owner: list[tuple[int, int]], order: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([n for _, n in owner])
    keys = grams(np.frombuffer(b"".join(parts), np.uint8), order)
    real = np.ones(len(keys), bool)
    for k in range(order):
        real[np.cumsum(lengths) - lengths + k] = False
    return keys[real], np.repeat(np.array([k for k, _ in owner], np.int32), lengths - order)


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in sorted ``keys``, -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


class Tree:
    """Context tree of one language from the counts of its grams of order K."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int):
        self.order, self.levels = order, [None] * (order + 1)
        for k in range(order, -1, -1):
            unique, inverse = np.unique(keys & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
            keys, counts = unique, np.bincount(inverse, counts, len(unique))
            context, at = np.unique(keys >> 8, return_inverse=True)
            self.levels[k] = {"gram": keys, "count": counts, "context": context, "at": at,
                              "total": np.bincount(at, counts, len(context)), "distinct": np.bincount(at, minlength=len(context)).astype(float)}
        for k in range(1, order + 1):  # what is left one level down when the symbols of a context are excluded
            here, below = self.levels[k], self.levels[k - 1]
            suffix = _find(below["context"], here["context"] & ((1 << 8 * (k - 1)) - 1))
            shared = below["count"][_find(below["gram"], here["gram"] & ((1 << 8 * k) - 1))]
            here["left_total"] = below["total"][suffix] - np.bincount(here["at"], shared, len(here["context"]))
            here["left_distinct"] = below["distinct"][suffix] - here["distinct"]

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """Exact code length of the last byte of each gram after the bytes before it."""
        bits, open_, above = np.zeros(len(keys)), np.ones(len(keys), bool), np.full(len(keys), -1)
        for k in range(self.order, -1, -1):
            level = self.levels[k]
            at = _find(level["context"], (keys >> 8) & ((1 << 8 * k) - 1))
            gram = _find(level["gram"], keys & ((1 << 8 * (k + 1)) - 1))
            total, distinct = level["total"][at].copy(), level["distinct"][at].copy()
            if k < self.order:
                escaped = above >= 0
                total[escaped] = self.levels[k + 1]["left_total"][above[escaped]]
                distinct[escaped] = self.levels[k + 1]["left_distinct"][above[escaped]]
            known, seen = open_ & (at >= 0), gram >= 0
            hit, miss = known & seen, known & ~seen & (distinct > 0)
            bits[hit] += np.log2((total[hit] + distinct[hit]) / level["count"][gram[hit]])
            bits[miss] += np.log2((total[miss] + distinct[miss]) / distinct[miss])
            above = np.where(known, at, -1)
            open_ &= ~hit
        unseen = 256 - (self.levels[0]["distinct"][0] if len(self.levels[0]["distinct"]) else 0)
        bits[open_] += np.log2(max(unseen, 1))
        return bits


@dataclass(eq=False)
class Model:
    """Frozen statistics: languages, and the distinct grams of each with counts. Models are equal if they are the same object."""

    order: int
    languages: list[str]
    keys: list[np.ndarray]
    counts: list[np.ndarray]


class Scorer:
    """Code lengths under all languages of a model; grams are looked up in two hashed tables."""

    def __init__(self, model: Model):
        self.order, self.languages = model.order, model.languages
        self.trees = [Tree(k, c, model.order) for k, c in zip(model.keys, model.counts)]
        self.keys = np.unique(np.concatenate([*model.keys, np.array([-1])]))
        self.costs = [t.bits(self.keys).astype(np.float32) for t in self.trees]
        self.shift = np.uint64(64 - max(10, int(4 * len(self.keys)).bit_length()))
        self.first, rest = self._table(np.arange(len(self.keys)), 0)
        self.second, _ = self._table(rest, 1)

    def _slot(self, keys: np.ndarray, which: int) -> np.ndarray:
        factor = np.uint64((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)[which])
        return ((keys.astype(np.uint64) * factor) >> self.shift).astype(np.int64)

    def _table(self, rows: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray]:
        slots = self._slot(self.keys[rows], which)
        table = np.zeros(1 << int(64 - self.shift), np.int32)
        table[slots] = rows
        return table, rows[table[slots] != rows]

    def _rows(self, keys: np.ndarray) -> np.ndarray:
        """Places of the grams, -1 where unseen; hashed a part at a time, as hashes take several times the memory of a block."""
        at = np.empty(len(keys), np.int64)
        for start in range(0, len(keys), PART_GRAMS):
            at[start:start + PART_GRAMS] = self._part_rows(keys[start:start + PART_GRAMS])
        return at

    def _part_rows(self, keys: np.ndarray) -> np.ndarray:
        at = self.first[self._slot(keys, 0)].astype(np.int64)
        left = np.flatnonzero(self.keys[at] != keys)
        again = self.second[self._slot(keys[left], 1)]
        at[left] = again
        left = left[self.keys[again] != keys[left]]
        at[left] = _find(self.keys, keys[left])
        return at

    def code_lengths(self, texts: list[str | None]) -> np.ndarray:
        """Bits of each text under each language: texts x languages."""
        out = np.zeros((len(texts), len(self.languages)))
        for keys, owner in blocks(texts, self.order, enough=SCORED_BYTES):
            at = self._rows(keys)
            missed = np.flatnonzero(at < 0)
            unseen, which = np.unique(keys[missed], return_inverse=True)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            for k, (tree, cost) in enumerate(zip(self.trees, self.costs)):
                bits = cost[at].astype(np.float64)
                bits[missed] = tree.bits(unseen).astype(np.float32)[which]
                np.add.at(out[:, k], owner[starts], np.add.reduceat(bits, starts))
        return out


def scorer_of(model: Model) -> Scorer:
    """The scorer of a model; a worker keeps it from task to task, and nothing else meanwhile."""
    return kept(("ppm", model), lambda: Scorer(model))


def train(spark: SparkSession, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key: Column | None = None,
          order: int = ORDER, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Fit the trees on about ``rows_per_language`` rows of each language, chosen by a hash of ``key``.

    Rows without a language or text are not learned from. A language with fewer rows is taken whole.
    The grams of the sample are counted by Spark; what reaches the driver is bounded by the sample,
    whatever the table's size.
    """
    bound_batches(spark)
    key = F.xxhash64(col(text_col)) if key is None else key
    rows = docs.select(col(text_col).alias("text"), col(lang_col).alias("lang"), F.pmod(F.xxhash64(key), F.lit(1 << 30)).alias("draw"))
    rows = rows.filter("text is not null and lang is not null")
    sizes = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(r["lang"] for r in sizes)
    share = [(r["lang"], languages.index(r["lang"]), int(min(1.0, rows_per_language / r["count"]) * (1 << 30))) for r in sizes]
    if not share:
        return Model(order, [], [], [])
    limits = F.broadcast(spark.createDataFrame(share, "lang string, language int, below long"))
    sample = rows.join(limits, "lang").filter("draw < below").select("language", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            language = batch.column(0).to_numpy(zero_copy_only=False)
            texts = np.array(batch.column(1).to_pylist(), object)
            for one in np.unique(language):
                for keys, _ in blocks(list(texts[language == one]), order):
                    unique, n = np.unique(keys, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(unique), one, np.int32)), pa.array(unique), pa.array(n)], ["language", "gram", "n"])

    counts = sample.mapInArrow(count, "language int, gram long, n long").groupBy("language", "gram").agg(F.sum("n").alias("n")).toArrow()
    language, gram, n = (counts.column(c).to_numpy() for c in ("language", "gram", "n"))
    chosen = [np.flatnonzero(language == k) for k in range(len(languages))]
    kept = [k for k, at in enumerate(chosen) if len(at)]
    return Model(order, [languages[k] for k in kept], [gram[chosen[k]] for k in kept], [n[chosen[k]].astype(float) for k in kept])


def identify(spark: SparkSession, text: Column, model: Model) -> Column:
    """Struct (lang_pred string, score double, bits_per_byte double) of whole texts.

    The language with the shortest code wins, the first by name of equals; score is its posterior
    under equal priors. A null text, one without a letter, and any text under a model without a
    language give ``und`` with score 0. Extra columns and repeated rows do not matter.
    """
    frozen = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, bits_per_byte double")
    def ppm(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = scorer_of(frozen.value) if frozen.value.languages else None
        for texts in batches:
            lettered = [t if t is not None and LETTER.search(t) else None for t in texts]
            if scorer is None or not len(texts):
                yield pd.DataFrame({"lang_pred": [UNDETERMINED] * len(texts), "score": 0.0, "bits_per_byte": 0.0})
                continue
            bits = scorer.code_lengths(lettered)
            best = bits.argmin(axis=1)
            least = bits.min(axis=1)
            score = np.minimum(1.0, 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1))
            size = np.array([len(t.encode()) if t else 0 for t in lettered])
            known = size > 0
            yield pd.DataFrame({"lang_pred": np.where(known, np.array(scorer.languages, object)[best], UNDETERMINED),
                                "score": np.where(known, score, 0.0), "bits_per_byte": least / np.maximum(size, 1)})
    return ppm(text)
