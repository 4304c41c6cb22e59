"""Exact duplicates and overlap between splits, by content hashes first and by the texts at last.

Texts are long and most occur once. So 64-bit content keys are counted first, the keys that occur again go into
a Bloom filter of fixed size, and only rows that pass it meet on their texts. A filter that is too full lets
more rows pass; the result stays exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of a Bloom filter, a power of two; 2 MB, about one key in a hundred passes by chance at a million keys.
FILTER_BITS = 1 << 24


def _probes(key: Column, bits: int) -> list[Column]:
    return [key.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(bits - 1))]


def bloom_filter(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> Column:
    """Bloom filter of a column of 64-bit keys: one array of words, ``bits`` bits in all, whatever the keys' number."""
    ones = keys.select(F.explode(F.array(*_probes(F.col(key), bits))).alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("mask"))
    words = keys.sparkSession.range(bits // 64).join(ones, F.col("id") == F.col("word"), "left").select("id", F.coalesce("mask", F.lit(0).cast("bigint")).alias("mask"))
    return words.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "mask"))), lambda w: w["mask"])).scalar()


def might_hold(bloom: Column, key: Column, bits: int = FILTER_BITS) -> Column:
    """False only for keys that are not in the filter."""
    hit = F.lit(True)
    for bit in _probes(key, bits):
        word = F.get(bloom, F.shiftright(bit, 6).cast("int"))
        hit = hit & (F.call_function("shiftright", word, bit.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return hit


def _named(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def dedup_exact(rows: DataFrame, text: str = "text", group: list[str] | None = None, row_id: str = "row_id",
                bits: int = FILTER_BITS) -> DataFrame:
    """One row of each (group, text), that with the least ``row_id``, and the number of its ``copies``.

    Nulls equal nulls, in texts as in groups. Of rows that share the least id, the least by their other columns
    stays. Rows whose content key occurs once are not shuffled; a text that a third of all rows repeat is
    combined map-side. ``rows`` is read three times, so it should be a stored table.
    """
    group = [] if group is None else group
    key = F.xxhash64(*[_named(c) for c in [*group, text]])
    again = rows.select(key.alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    maybe = might_hold(bloom_filter(again, "key", bits), key, bits)
    rest = [c for c in rows.columns if c not in (row_id, text, *group)]
    whole = [_named(c) for c in rows.columns]
    first = rows.filter(maybe).groupBy(*[_named(c) for c in [*group, text]]).agg(
        F.min(F.struct(*[_named(c) for c in [row_id, *rest]])).alias("_first"), F.count(F.lit(1)).alias("copies"))
    kept = first.select(*[(_named(c) if c in group or c == text else F.col("_first")[c]).alias(c) for c in rows.columns], "copies")
    return rows.filter(~maybe).select(*whole, F.lit(1).cast("bigint").alias("copies")).unionByName(kept)


def split_overlap(rows: DataFrame, text: str = "text", group: list[str] | None = None, split: str = "split",
                  train: str = "train", bits: int = FILTER_BITS) -> DataFrame:
    """Per group and held-out split: ``rows``, and ``in_train``, those whose text the group's train rows hold too.

    Train rows are reduced by a Bloom filter of the held-out contents before they are compared by text. Rows
    without a split are not counted.
    """
    group = [] if group is None else group
    content = [_named(c) for c in [*group, text]]
    key = F.xxhash64(*content)
    held_out = rows.filter(_named(split) != train)
    copies = held_out.groupBy(*content, _named(split).alias(split)).agg(F.count(F.lit(1)).alias("_n"))  # a hot text is one row
    bloom = bloom_filter(held_out.select(key.alias("key")), "key", bits)
    names = [f"_t{k}" for k in range(len(content))]
    known = rows.filter((_named(split) == train) & might_hold(bloom, key, bits)).select(
        *[c.alias(n) for c, n in zip(content, names)], key.alias("_train_key")).distinct().withColumn("_held", F.lit(True))
    same = key == F.col("_train_key")
    for c, n in zip(content, names):
        same = same & c.eqNullSafe(F.col(n))
    return copies.join(known, same, "left").groupBy(*[_named(c) for c in group], _named(split).alias("split")).agg(
        F.sum("_n").alias("rows"), F.coalesce(F.sum(F.when(F.col("_held"), F.col("_n"))), F.lit(0).cast("bigint")).alias("in_train"))
