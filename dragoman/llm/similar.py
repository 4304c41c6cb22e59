"""Components of shingle sets by exact Jaccard similarity, for sets that share a band key.

No bucket is cut. Buckets of ``GROUP`` sets or fewer are compared pair by pair, larger ones first with their
least set alone. Only pairs of different components can still change anything, so the larger buckets that
hold several components are split into blocks and compared block with block: each pair in one task only,
counted there by products of incidence matrices, so that no table of pairs is ever made.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dragoman.llm.common import through_table
from dragoman.llm.graph import connected_components

#: Sets of a bucket up to which its pairs are rows.
GROUP = 8
#: Sets of one block.
BLOCK = 256
_COLUMNS = 1 << 14


def in_shared_buckets(members: DataFrame) -> DataFrame:
    """Of distinct (key, content), those whose key has several contents, with their number ``n`` and the ``least``."""
    buckets = members.groupBy("key").agg(F.count("*").alias("n"), F.min("content").alias("least")).filter("n > 1")
    return members.join(buckets, "key")


def _incidence(parts: list[list[np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, column) of each element, by part; elements of a single set, which no two sets share, are left out."""
    flat = np.concatenate([x for part in parts for x in part])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1
    number, out, at = np.cumsum(shared) - 1, [], 0
    for part in parts:
        sizes = [len(x) for x in part]
        own, row = column[at:at + sum(sizes)], np.repeat(np.arange(len(part)), sizes)
        at += sum(sizes)
        use = shared[own]
        row, own = row[use], number[own[use]]
        order = np.argsort(own, kind="stable")
        out.append((row[order], own[order]))
    return out


def near(a: list[np.ndarray], b: list[np.ndarray] | None, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the pairs of sets of ``a`` and ``b`` (of ``a`` itself if null) with the Jaccard similarity. Sets hold distinct elements."""
    found = _incidence([a] if b is None else [a, b])
    (row_a, col_a), (row_b, col_b), other = found[0], found[-1], a if b is None else b
    shared = np.zeros((len(a), len(other)))
    for k in range(0, 1 + max(col_a.max(initial=-1), col_b.max(initial=-1)), _COLUMNS):
        blocks = []
        for rows, cols, n in ((row_a, col_a, len(a)), (row_b, col_b, len(other))):
            low, high = np.searchsorted(cols, [k, k + _COLUMNS])
            block = np.zeros((n, _COLUMNS), np.float32)  # sums of ones up to 2^14 are exact
            block[rows[low:high], cols[low:high] - k] = 1
            blocks.append(block)
        shared += blocks[0] @ blocks[1].T
    size_a, size_b = np.array([len(x) for x in a]), np.array([len(x) for x in other])
    return np.nonzero(shared / np.maximum(size_a[:, None] + size_b[None, :] - shared, 1) >= similarity)


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the same components as the edges (a, b), one for each node but the least of a component."""
    names, number = np.unique(np.r_[a, b], return_inverse=True)
    a, b, label = number[:len(a)], number[len(a):], np.arange(len(names))
    while True:
        least, now = np.minimum(label[a], label[b]), label.copy()
        np.minimum.at(now, a, least)
        np.minimum.at(now, b, least)
        now = now[now]
        if (now == label).all():
            moved = np.flatnonzero(label != np.arange(len(names)))
            return names[moved], names[label[moved]]
        label = now


def _verified(pairs: DataFrame, grams: DataFrame, similarity: float) -> DataFrame:
    both = pairs.join(grams.select(F.col("content").alias("a"), F.col("grams").alias("ga")), "a").join(
        grams.select(F.col("content").alias("b"), F.col("grams").alias("gb")), "b")
    shared = F.size(F.array_intersect("ga", "gb"))
    return both.filter(shared / (F.size("ga") + F.size("gb") - shared) >= similarity).select("a", "b")


def _compared(similarity: float):
    def compare(key, block):
        own, name = block["block"].to_numpy(), block["component"].to_numpy()
        none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        if (name == name[0]).all():
            return none
        sets = [x.values.to_numpy() for x in block["grams"]]
        low, high = np.flatnonzero(own == key[1].as_py()), np.flatnonzero(own == key[2].as_py())
        if not len(low) or not len(high):
            return none
        alone = key[1].as_py() == key[2].as_py()
        a, b = near([sets[k] for k in low], None if alone else [sets[k] for k in high], similarity)
        a, b = name[low[a]], name[high[b]]
        a, b = spanning(a[a != b], b[a != b])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return compare


def components(shared: DataFrame, grams: DataFrame, similarity: float, group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """Components (node, component) over all pairs of contents that share a key and have the Jaccard similarity.

    ``shared`` comes from ``in_shared_buckets`` and is, like ``grams`` (content, grams: distinct elements), a stored table.
    A content without a partner has no row.
    """
    small, large = shared.filter(F.col("n") <= group), shared.filter(F.col("n") > group)
    within = small.select("key", F.col("content").alias("a")).join(small.select("key", F.col("content").alias("b")), "key").filter("a < b").select("a", "b")
    star = large.filter("least < content").select(F.col("least").alias("a"), F.col("content").alias("b"))
    pairs = through_table(within.union(star).distinct(), "pairs")
    named = connected_components(_verified(pairs, grams, similarity))
    if large.isEmpty():
        return named
    named = through_table(named, "named")
    inside = large.join(named.withColumnRenamed("node", "content"), "content", "left").select("key", "n", "content", F.coalesce("component", "content").alias("component"))
    inside = through_table(inside, "large-buckets")
    mixed = inside.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
    blocks = F.ceil(F.col("n") / block)
    dealt = inside.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("content"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    dealt = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "component", "content")
    open_ = dealt.join(grams, "content").select("key", "i", "j", "block", "component", "grams")
    more = open_.groupBy("key", "i", "j").applyInArrow(_compared(similarity), "a long, b long")
    return connected_components(named.select(F.col("node").alias("a"), F.col("component").alias("b")).union(through_table(more, "block-links")))
