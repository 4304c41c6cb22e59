"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length.

Folding undoes case, accents, look-alike letters, and digits and signs that stand for letters in a word
that holds a letter. Lexicon entries are word starts or whole words; each has a weight, and each word of a
text counts by its heaviest entry, unless it lies inside an exception phrase. Entries, weights and exception
phrases are learned from labelled rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dragoman.llm.common import bound_batches

# fixed values: letters of other alphabets that look like Latin ones, and signs used for letters
LOOK_ALIKE = dict(zip("\u0430\u0432\u0435\u043a\u043c\u043d\u043e\u0440\u0441\u0442\u0443\u0445\u0456\u0458\u0455\u0501\u04cf\u0261\u03b1\u03b2\u03b5\u03b9\u03ba\u03bd\u03bf\u03c1\u03c4\u03c5\u03c7\u2113", "abekmhopctyxijsdlgabeikvoptuxl"))
STAND_IN = str.maketrans(dict(zip("013457@$", "oieastas")))
UNSEEN = {**{chr(k): None for k in range(0x300, 0x370)}, "\u200b": None, "\u200d": None, "\u00ad": None}
FOLD = str.maketrans({**LOOK_ALIKE, **UNSEEN})
STANDS = re.compile("[013457@$]")
TOKEN = re.compile(r"(?:[^\W_]|[@$])+")
LETTER = re.compile(r"[^\W\d_]")
WORD = re.compile(r"[^\W_]+")
# fixed values: phrases in which a lexicon word is harmless, whatever the labelled rows say
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "class clown", "scum of algae", "pond scum", "sore loser rule", "idiot proof")

MIN_PREFIX, MAX_PREFIX = 4, 10
#: Labelled rows that the lexicon and the calibration are fitted on, about, of each label: the documented bound.
ROWS_PER_LABEL = 6000
LEXICON_SIZE = 2000
#: Learned exception phrases at most; a phrase needs this many harmless rows.
EXCEPTION_SIZE = 2000
MIN_FINE_ROWS = 4
MIN_TOXIC_ROWS = 4
#: An entry's rows are toxic this many times likelier than an average row, at least.
MIN_ODDS = 20.0


def folded_words(text: str | None) -> list[str]:
    """Words of the folded text; digits and signs become letters only in words that hold a letter."""
    if not text:
        return []
    plain = text.casefold()
    if not plain.isascii():
        plain = unicodedata.normalize("NFKD", plain).translate(FOLD)
    if not STANDS.search(plain):
        return WORD.findall(plain)
    words = []
    for token in TOKEN.findall(plain):
        if token.isalpha():
            words.append(token)
        elif LETTER.search(token):
            words.append(token.translate(STAND_IN))
        else:
            words.extend(WORD.findall(token))  # a number, an amount
    return words


def features(words: Iterable[str]) -> set[str]:
    """Word starts (' abcd') and whole words (' abcdef ') of a text."""
    out = set()
    for word in set(words):
        if len(word) >= 3:
            out.add(f" {word} ")
        out.update(f" {word[:k]}" for k in range(MIN_PREFIX, min(MAX_PREFIX, len(word)) + 1))
    return out


@dataclass
class Lexicon:
    """Entries with weights, exception phrases, and the calibration (bias, slopes)."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    calibration: tuple[float, float, float] = (-2.0, 1.0, 0.0)
    base_rate: float = field(default=0.1)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.calibration = lexicon.calibration
        self.automaton = ahocorasick.Automaton()
        for entry, weight in lexicon.weights.items():
            self.automaton.add_word(entry, (len(entry), weight))
        for phrase in lexicon.exceptions:
            phrase = " " + " ".join(folded_words(phrase)) + " "
            self.automaton.add_word(phrase, (len(phrase), 0.0))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    def measures(self, text: str | None) -> tuple[float, float, int]:
        """(summed weight of the matched words, words, matched words)."""
        words = folded_words(text)
        hits = self.hits(words)
        return float(sum(hits.values())), len(words), len(hits)

    def hits(self, words: list[str]) -> dict[int, float]:
        """Weight of each matched word that no exception spares, by the place of the space before it in the joined words."""
        hits: dict[int, float] = {}
        if self.empty or not words:
            return hits
        spared, line = [], " " + " ".join(words) + " "
        for end, (size, weight) in self.automaton.iter(line):
            start = end - size + 1
            if weight == 0.0:
                spared.append((start, end))
            elif weight > hits.get(start, 0.0):
                hits[start] = weight
        for start, end in spared:
            for k in [k for k in hits if start <= k < end]:
                del hits[k]
        return hits

    def phrases(self, text: str | None) -> set[str]:
        """Matched words with the word before them, and with the word after them."""
        words, out, at = folded_words(text), set(), 0
        hits = self.hits(words)
        for k, word in enumerate(words if hits else ()):
            if at in hits:
                out.update(" ".join(pair) for pair in (words[max(k - 1, 0):k + 1], words[k:k + 2]) if len(pair) == 2)
            at += len(word) + 1
        return out

    def score(self, weight: float, words: int) -> float:
        bias, total, rate = self.calibration
        return float(1 / (1 + np.exp(-np.clip(bias + total * np.log1p(weight) + rate * np.log1p(100 * weight / max(words, 1)), -30, 30))))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, rows_per_label: int = ROWS_PER_LABEL, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Learn entries, weights and exceptions from one half of a bounded sample of labelled rows, the calibration from the other.

    An exception is a matched word with a neighbour that stands in ``MIN_FINE_ROWS`` harmless rows and is
    likelier there than in toxic rows.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic. The sample holds about ``rows_per_label``
    rows of each label, chosen by a hash of doc_id; its ids are broadcast (their number is the bound), so
    no text is shuffled. Without a row of each label the lexicon is empty and every score is low.
    """
    bound_batches(spark)
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if set(sizes) != {0, 1}:
        return Lexicon({}, exceptions)
    below = F.when(F.col("toxic") == 1, min(1.0, rows_per_label / sizes[1]) * (1 << 30)).otherwise(min(1.0, rows_per_label / sizes[0]) * (1 << 30))
    draw = F.xxhash64(F.lit("toxicity"), "doc_id")
    known = known.filter(F.pmod(draw, F.lit(1 << 30)) < below).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").withColumn("half", F.pmod(F.shiftright(draw, 32), F.lit(2)).cast("int"))

    learn = sample.filter("half = 0")
    counts = _counted(learn, lambda: lambda text: features(folded_words(text)))
    rows = {r["toxic"]: r["count"] for r in learn.groupBy("toxic").count().collect()}
    bad, fine = rows.get(1, 0) + 1.0, rows.get(0, 0) + 1.0
    odds = ((F.col("bad") + 0.5) / bad) / ((F.col("fine") + 0.5) / fine)
    best = counts.filter((F.col("bad") >= MIN_TOXIC_ROWS) & (odds >= MIN_ODDS)).select("entry", F.log(odds).alias("weight"), "bad")
    best = best.orderBy(F.desc(F.col("bad") * F.col("weight")), "entry").limit(LEXICON_SIZE).collect()
    lexicon = Lexicon({r["entry"]: r["weight"] for r in best}, exceptions)
    spared = _counted(learn, lambda: Matcher(lexicon).phrases).filter((F.col("fine") >= MIN_FINE_ROWS) & (odds < 1))
    spared = spared.orderBy(F.desc("fine"), "entry").limit(EXCEPTION_SIZE).collect()
    lexicon.exceptions = (*exceptions, *(r["entry"] for r in spared))
    rest = sample.filter("half = 1").select("toxic", measures(spark, F.col("text"), lexicon).alias("m")).select("toxic", "m.weight", "m.words").toPandas()
    lexicon.calibration = _calibrate(rest, sizes)
    return lexicon


def _counted(rows: DataFrame, finder: Callable[[], Callable[[str], set[str]]]) -> DataFrame:
    """(entry, bad, fine): toxic and harmless rows that hold each entry; ``finder`` makes a task's function from a text to its entries."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finder()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = list(find(text))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([toxic] * len(found), pa.int64())], ["entry", "toxic"])

    return rows.select("text", "toxic").mapInArrow(count, "entry string, toxic long").groupBy("entry").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("fine"))


def _calibrate(rows: pd.DataFrame, sizes: dict[int, int]) -> tuple[float, float, float]:
    """Logistic regression by Newton's method on the bounded half; rows weigh as their label does in the table."""
    if rows.toxic.nunique() < 2:
        return (-2.0, 1.0, 0.0)
    y = rows.toxic.to_numpy(float)
    x = np.c_[np.ones(len(rows)), np.log1p(rows.weight), np.log1p(100 * rows.weight / np.maximum(rows.words, 1))]
    share = sizes[1] / (sizes[0] + sizes[1])
    w = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        ridge = np.diag([1e-6, 1e-2, 1e-2])
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (w * (y - p)) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def measures(spark: SparkSession, text: Column, lexicon: Lexicon) -> Column:
    """Struct (score, weight, words, hits) of whole texts; null and empty texts have no word and the score of no hit.

    The lexicon holds ``LEXICON_SIZE`` entries at most and is broadcast. Every row is scored by itself.
    """
    frozen = spark.sparkContext.broadcast(lexicon)

    @F.pandas_udf("score double, weight double, words long, hits long")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(frozen.value)
        for texts in batches:
            got = [matcher.measures(t) for t in texts]
            yield pd.DataFrame({"score": [matcher.score(w, n) for w, n, _ in got], "weight": [float(w) for w, _, _ in got],
                                "words": [n for _, n, _ in got], "hits": [h for _, _, h in got]})
    return toxicity(text)
