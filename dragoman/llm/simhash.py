"""SimHash fingerprints, and near duplicates through BK-trees over shards of fingerprints.

Two 64-bit fingerprints that differ in at most r bits agree on at least one of r + 1 blocks of bits.
A shard holds the fingerprints that share the value of one block, so every link lies inside a shard.
Each shard gets a BK-tree (children keyed by their integer Hamming distance to the parent), and a
search follows only the edges within the radius. A shard larger than its bound is split again by
r + 1 blocks of the bits not yet fixed, as often as needed: exact, with no cap on partners. The trees
of all fingerprints grow with the corpus, so a shard's tree travels by a shuffle, not by a broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from dragoman.llm.common import bound_batches, col, fresh, through_table
from dragoman.llm.graph import connected_components

BITS = 64
#: Fingerprints of one BK-tree at most.
SHARD_ROWS = 512
#: Fingerprints searched by one call; bounds a task's memory.
BLOCK_ROWS = 4096


def fingerprint_of(text: str | None, shingle_words: int) -> int:
    """Majority bits of the shingles' XXH64; 0 without a word. Only A-Z are lower-cased."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle_words))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k:k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle_words: int = 3) -> Column:
    """Signed 64-bit SimHash of whole texts; null and wordless texts give 0."""
    @F.pandas_udf(LongType())
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle_words) for t in texts], dtype="int64")
    return simhash(text)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Forest:
    """BK-trees over the shards of ``values``; rows of a shard are adjacent and distinct."""

    def __init__(self, values: np.ndarray, shards: np.ndarray):
        self.values = values
        starts = np.r_[True, shards[1:] != shards[:-1]]
        self.root = np.flatnonzero(starts)[np.cumsum(starts) - 1]
        at, keys, children = self.root.copy(), [], []
        rest = np.flatnonzero(~starts)
        while len(rest):
            edge = at[rest] * (BITS + 1) + distance(values[rest], values[at[rest]])
            unique, first, inverse = np.unique(edge, return_index=True, return_inverse=True)
            child = rest[first]
            keys.append(unique)
            children.append(child)
            at[rest] = child[inverse]
            rest = rest[at[rest] != rest]
        keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.children = np.concatenate(children)[order] if len(keys) else np.zeros(0, np.int64)

    def within(self, radius: int, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) at ``radius`` or less; queries are row numbers."""
        query, node, found = queries, self.root[queries], []
        while len(query):
            d = distance(self.values[query], self.values[node])
            hit = d <= radius
            found.append((query[hit], node[hit]))
            low = np.searchsorted(self.keys, node * (BITS + 1) + np.maximum(d - radius, 0))
            high = np.searchsorted(self.keys, node * (BITS + 1) + np.minimum(d + radius, BITS), "right")
            n = high - low
            query = np.repeat(query, n)
            node = self.children[np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (queries[:0], queries[:0])


def local_roots(values: np.ndarray, shards: np.ndarray, radius: int) -> np.ndarray:
    """The first row that each row is linked to, directly or not, inside its shard."""
    forest, label = Forest(values, shards), np.arange(len(values))
    pairs = [forest.within(radius, np.arange(k, min(k + 1024, len(values)))) for k in range(0, len(values), 1024)]
    a, b = (np.concatenate(x) for x in zip(*pairs))
    a, b = a[a != b], b[a != b]
    while True:
        least = np.minimum(label[a], label[b])
        now = label.copy()
        np.minimum.at(now, a, least)
        np.minimum.at(now, b, least)
        now = now[now]
        if (now == label).all():
            return label
        label = now


def _shard_edges(radius: int):
    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(fp: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
            root = local_roots(fp, shard, radius)
            moved = root != np.arange(len(fp))
            return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[root[moved]])], ["a", "b"])

        fp, shard = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            fp = np.r_[fp, batch.column(0).to_numpy(zero_copy_only=False)]
            shard = np.r_[shard, batch.column(1).to_numpy(zero_copy_only=False)]
            while len(fp) > BLOCK_ROWS and shard[0] != shard[-1]:
                # up to the last border of shards in the block, or else the first after it
                borders = np.flatnonzero(shard[1:] != shard[:-1]) + 1
                inside = borders[borders <= BLOCK_ROWS]
                cut = inside[-1] if len(inside) else borders[0]
                yield linked(fp[:cut], shard[:cut])
                fp, shard = fp[cut:], shard[cut:]
        if len(fp):
            yield linked(fp, shard)
    return edges


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _blocks(mask: int, radius: int) -> list[int]:
    """``mask`` with each of radius + 1 blocks of its free bits fixed as well."""
    free = [k for k in range(BITS) if not mask >> k & 1]
    size = -(-len(free) // (radius + 1))
    blocks = [free[k:k + size] for k in range(0, len(free), size)] or [[]]
    return [mask | sum(1 << k for k in block) for block in blocks]


def links(fingerprints: DataFrame, radius: int = 2, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs at ``radius`` or less.

    ``fingerprints`` holds distinct values ``fp``. A dense shard yields one edge per row, never all pairs.
    """
    spark, out = fingerprints.sparkSession, None
    masks, rows, depth = [0], fingerprints.select("fp", F.lit(0).cast("long").alias("mask")), 0
    while True:
        parts = {m: _blocks(m, radius) for m in masks}
        narrower = spark.createDataFrame([(_signed(m), _signed(x)) for m, xs in parts.items() for x in xs], "mask long, deeper long")
        if depth == 0:
            rows = rows.select("fp", F.explode(F.array(*[F.lit(_signed(x)) for x in parts[0]])).alias("mask"))
        else:  # at most (radius + 1) ** depth masks
            rows = rows.join(F.broadcast(narrower), "mask").select("fp", F.col("deeper").alias("mask"))
        rows = rows.select("fp", "mask", F.xxhash64("mask", F.col("fp").bitwiseAND(F.col("mask"))).alias("shard")).distinct()
        sizes = rows.groupBy("shard").count().filter("count > 1")
        rows = through_table(rows.join(sizes, "shard"), "shards")
        masks = sorted({x for xs in parts.values() for x in xs})
        last = min(BITS - x.bit_count() for x in masks) <= 6  # such a shard holds 2^6 distinct values at most
        small = rows if last else rows.filter(F.col("count") <= shard_rows)
        edges = (small.select("fp", "shard").repartition("shard").sortWithinPartitions("shard")
                 .mapInArrow(_shard_edges(radius), "a long, b long"))
        out = edges if out is None else out.union(edges)
        rows = rows.filter(F.col("count") > shard_rows).select("fp", "mask")
        if last or rows.isEmpty():
            return out
        depth += 1


def components(groups: DataFrame, radius: int = 2) -> DataFrame:
    """``groups`` (distinct ``fp``, other columns) with ``component``: a value common to all fingerprints reachable over links of ``radius`` or less.

    ``groups`` is a stored table, as it is read several times.
    """
    component = connected_components(links(groups.select("fp"), radius))
    return groups.join(component.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                    radius: int = 2) -> DataFrame:
    """One row per row of ``docs``: (id, fingerprint of 16 hex digits, component_id).

    component_id is the smallest id reachable over links of at most ``radius`` differing bits, itself
    included. Null and wordless texts have fingerprint zero and link like any other. Repeated rows
    stay repeated. A null id is never a component_id, unless no row of the component has an id.
    An empty table gives no rows. Other columns of ``docs`` are not read.
    """
    bound_batches(docs.sparkSession)
    marked = through_table(docs.select(col(id_col).alias("doc_id"), fingerprint(col(text_col), shingle_words).alias("fp")), "fingerprints")
    groups = through_table(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "groups")
    named = through_table(components(groups, radius), "named")
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_fp = named.join(least, "component").select("fp", "component_id")
    return marked.join(by_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, radius: int = 2) -> DataFrame:
    """``docs`` without near duplicates: of each component the row with the smallest id stays.

    All columns are kept. Of rows that repeat the kept id one stays; rows with a null id stay all.
    """
    kept = near_duplicates(docs, id_col, text_col, shingle_words, radius).filter("doc_id = component_id").select("doc_id").distinct()
    (key,) = fresh(docs, "_kept_id")
    named = docs.filter(col(id_col).isNotNull())
    named = named.join(kept.withColumnRenamed("doc_id", key), col(id_col) == col(key), "left_semi").dropDuplicates([id_col])
    return named.unionByName(docs.filter(col(id_col).isNull()))
