"""Substring de-duplication: near-equal paragraphs by MinHash bands, and long passages inside others.

Paragraphs (lines of ``MIN_WORDS`` words or more) are banded on MinHashes of their five-word shingles,
colliding ones are verified by exact Jaccard similarity, and components of the verified links are
clusters. A passage set into a longer paragraph shares too little with it for that, so runs of
``RUN_WORDS`` words that start at winnowed words are units too, with one band of all their words: any
passage of ``MIN_WORDS`` + 1 words in two texts holds such a run in both, wherever it lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from dragoman.llm import similar
from dragoman.llm.common import bound_batches, col, through_table

SHINGLE = 5
MIN_WORDS = 50
RUN_WORDS = 40
WINNOW = MIN_WORDS + 1 - RUN_WORDS      # of so many neighbouring starts one is chosen
SIMILARITY, RECALL = 0.8, 0.99

_A, _B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F | 1
_M64 = (1 << 64) - 1


def tuned_bands(similarity: float = SIMILARITY, recall: float = RECALL, most: int = 10) -> tuple[int, int]:
    """(bands, rows): the most rows a band for which at most ``most`` bands reach ``recall`` at ``similarity``."""
    best = (1, 1)
    for rows in range(1, 17):
        bands = next((b for b in range(1, most + 1) if 1 - (1 - similarity**rows) ** b >= recall), None)
        if bands:
            best = bands, rows
    return best


BANDS, ROWS = tuned_bands()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as were ever needed."""

    def __init__(self, base: int):
        self.base, self.inverse, self.up, self.down = base, pow(base, -1, 1 << 64), np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 12) * 2
            for name, factor in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, factor, np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_CHARS, _WORDS = _Powers(_A), _Powers(_B)
_BLANK = np.array([chr(c).isspace() for c in range(0x10000)])


def _runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """A hash of each run [start, end) of values that depends on the values alone."""
    up, down = powers(len(values) + 1)
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(values * up[:-1], dtype=np.uint64)]
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, line) of each word, words being runs of what is no white space."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    blank = np.r_[True, (points < 0x10000) & _BLANK[np.minimum(points, 0xFFFF)], True]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    hashes = _runs(points.astype(np.uint64) + np.uint64(1), starts, ends, _CHARS)
    line = np.cumsum(points == 10)[starts] if len(starts) else starts
    return hashes, starts, ends, line


def anchors(hashes: np.ndarray) -> np.ndarray:
    """Winnowed starts: for every ``WINNOW`` neighbouring word pairs the last of the least hash."""
    if len(hashes) < RUN_WORDS:
        return np.zeros(0, np.int64)
    mask = np.uint64((1 << 24) - 1)
    pairs = mix(hashes[:-1] * np.uint64(_B) + hashes[1:])
    place = np.arange(len(pairs), dtype=np.uint64)
    key = (pairs & ~mask) | (mask - (place & mask))
    least, width = key, 1
    while width < WINNOW and len(least) > 1:
        step = min(width, WINNOW - width)
        if len(least) <= step:
            return np.zeros(0, np.int64)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    first = np.arange(len(least), dtype=np.uint64)
    at = first + ((mask - (least & mask) - first) & mask)
    at = np.unique(at).astype(np.int64)
    return at[at + RUN_WORDS <= len(hashes)]


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Distinct hashes of the five-word shingles; the whole sequence if it is shorter."""
    n = len(hashes)
    size = min(SHINGLE, n)
    starts = np.arange(n - size + 1)
    return np.unique(_runs(hashes, starts, starts + size, _WORDS))


def band_keys(sets: list[np.ndarray], bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """Band keys of several shingle sets: sets x bands. All hash functions are applied to all sets at once."""
    salts = mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(_A))
    joined, starts = np.concatenate(sets), np.r_[0, np.cumsum([len(x) for x in sets])[:-1]]
    step = max(1, (1 << 20) // len(joined))  # hash functions at once, so that long texts stay within memory
    least = np.concatenate([np.minimum.reduceat(mix(joined[None, :] ^ salts[k:k + step, None]), starts, axis=1) for k in range(0, len(salts), step)])
    least = least.reshape(bands, rows, len(sets))
    key = np.repeat((np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(_A))[:, None], len(sets), axis=1)
    for k in range(rows):
        key = mix(key * np.uint64(_B) + least[:, k])
    return key.T


def paragraphs(text: str, words=None) -> list[tuple[int, int, np.ndarray]]:
    """(start, end, word hashes) of each line with ``MIN_WORDS`` words or more."""
    hashes, starts, ends, line = word_spans(text) if words is None else words
    cuts = np.flatnonzero(np.r_[True, line[1:] != line[:-1], True]) if len(line) else []
    return [(int(starts[a]), int(ends[b - 1]), hashes[a:b]) for a, b in zip(cuts[:-1], cuts[1:]) if b - a >= MIN_WORDS]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, kind, doc_id, start, end, content): kind 0 a run of words, kind 1 a band of a paragraph."""
    names = ["key", "kind", "doc_id", "start", "end", "content"]
    for batch in batches:
        parts = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = word_spans(text)
            hashes, starts, ends, _ = words
            at = anchors(hashes)
            if len(at):
                key, first = np.unique(_runs(hashes, at, at + RUN_WORDS, _WORDS), return_index=True)
                parts.append((key, np.zeros(len(key)), np.full(len(key), doc), starts[at[first]], ends[at[first] + RUN_WORDS - 1], key))
            found = paragraphs(text, words)
            if found:
                size = np.array([len(inner) for _, _, inner in found])
                edge = np.r_[0, np.cumsum(size)]
                content = _runs(np.concatenate([inner for _, _, inner in found]), edge[:-1], edge[1:], _WORDS)
                n = len(found) * BANDS
                parts.append((band_keys([shingles(inner) for _, _, inner in found]).ravel(), np.ones(n), np.full(n, doc), np.repeat([x[0] for x in found], BANDS),
                              np.repeat([x[1] for x in found], BANDS), np.repeat(content, BANDS)))
        if parts:
            c = [np.concatenate(x) for x in zip(*parts)]
            yield pa.RecordBatch.from_arrays([pa.array(_signed(c[0])), pa.array(c[1].astype(np.int8)), pa.array(c[2].astype(np.int64)), pa.array(c[3].astype(np.int32)),
                                              pa.array(c[4].astype(np.int32)), pa.array(_signed(c[5]))], names)


def _grams(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(content, grams): the shingles of paragraph contents. ``places`` (content, at) names one text and start for each, ``docs`` holds the texts."""
    wanted = places.groupBy("at.doc_id").agg(F.collect_set(F.struct("at.start", "content")).alias("wanted"))  # a text's own paragraphs

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_start = {start: hashes for start, _, hashes in paragraphs(text)}
                got = [(x["content"], _signed(shingles(by_start[x["start"]]))) for x in wanted if x["start"] in by_start]
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in got], pa.int64()), pa.array([s for _, s in got], pa.list_(pa.int64()))], ["content", "grams"])
    grams = docs.join(wanted, "doc_id").select("text", "wanted").mapInArrow(sets, "content long, grams array<long>").dropDuplicates(["content"])
    return through_table(grams, "paragraph-grams")


def duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Spans to remove: (doc_id, start, end, kept_doc_id, cluster_id), one row per merged span of a text.

    A unit of a cluster stays in the text with the smallest id (there the first) and goes from all others; overlapping
    spans of a text are merged, and ``kept_doc_id`` and ``cluster_id`` are those of the first one merged. Offsets are code
    points, the end is exclusive. Repeats inside one text, null texts and rows without an id give no span; rows that repeat
    an id with its text count once. An empty table gives no rows.
    """
    bound_batches(spark)
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text")).filter("doc_id is not null and text is not null")
    units = through_table(rows.mapInArrow(_units, "key long, kind byte, doc_id long, start int, end int, content long"), "units")
    at = F.struct("doc_id", "start")
    # whole runs of words: equal keys are equal texts
    runs = units.filter("kind = 0")
    first = runs.groupBy("key").agg(F.min("doc_id").alias("kept_doc_id"), F.max("doc_id").alias("last")).filter("last > kept_doc_id").drop("last")
    spans = runs.join(first.hint("shuffle_hash"), "key").filter("doc_id > kept_doc_id").select("doc_id", "start", "end", "kept_doc_id", F.col("key").alias("cluster_id"))
    # paragraphs: equal contents are one, colliding contents are verified
    bands = units.filter("kind = 1")
    contents = bands.groupBy("key", "content").agg(F.min(at).alias("at"))
    shared = through_table(similar.in_shared_buckets(contents), "buckets")
    grams = _grams(rows.dropDuplicates(["doc_id"]), shared.groupBy("content").agg(F.min("at").alias("at")))
    named = similar.components(shared.drop("at"), grams, similarity)
    own = bands.select("content", "doc_id", "start", "end").distinct()
    own = own.join(named.withColumnRenamed("node", "content"), "content", "left").withColumn("cluster_id", F.coalesce("component", "content"))
    own = through_table(own.select("cluster_id", "doc_id", "start", "end"), "paragraphs")
    least = own.groupBy("cluster_id").agg(F.min("doc_id").alias("kept_doc_id"), F.max("doc_id").alias("last")).filter("last > kept_doc_id").drop("last")
    whole = own.join(least.hint("shuffle_hash"), "cluster_id").filter("doc_id > kept_doc_id").select("doc_id", "start", "end", "kept_doc_id", "cluster_id")
    # a text's spans, merged where they overlap
    order = Window.partitionBy("doc_id").orderBy("start", "end", "cluster_id")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.union(whole).withColumn("new", (F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int")).withColumn("island", F.sum("new").over(order))
    first = F.struct("start", "end", "cluster_id", "kept_doc_id")
    merged = islands.groupBy("doc_id", "island").agg(F.min(first).alias("first"), F.max("end").alias("end"))
    return merged.select("doc_id", "first.start", "end", "first.kept_doc_id", "first.cluster_id")
