"""Left lookup join that survives a hot key on the fact side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


#: Hot keys at most.
MAX_HOT = 10_000


def salted_left_join(facts: DataFrame, dim: DataFrame, key: str, spread_by: list[str],
                     hot_rows: int = 1_000_000, salts: int = 64) -> DataFrame:
    """``facts left join dim`` on ``key`` (unique in ``dim``), hot keys spread over tasks.

    A key is hot when it has at least ``hot_rows`` fact rows and a part of ``1 / MAX_HOT``
    of all. So there are at most ``MAX_HOT`` hot keys, and their 64-bit hashes are broadcast.
    Hot fact rows, null keys among them, get a salt from ``spread_by``; only the hot keys of
    ``dim`` are repeated per salt. Keys of equal hash are salted alike, which changes nothing.
    """
    hashed = lambda df: df.withColumn("_hash", F.xxhash64(key))
    facts, dim = hashed(facts), hashed(dim)
    total = facts.agg(F.count(F.lit(1))).scalar()
    hot = (facts.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows"))
           .filter(F.col("_rows") >= F.greatest(F.lit(hot_rows), total / MAX_HOT))
           .select("_hash", F.lit(True).alias("_hot")))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    left = facts.join(F.broadcast(hot), "_hash", "left").withColumn("_salt", salt).drop("_hot", "_hash")
    repeats = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = dim.join(F.broadcast(hot), "_hash", "left").withColumn("_salt", F.explode(repeats)).drop("_hot", "_hash")
    return left.join(right, [key, "_salt"], "left").drop("_salt")
