"""Exact duplicates and split overlap: brute force, full filters, nulls, hot texts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dragoman.operators import dedup


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    texts = ["hot text"] * 10 + [f"text {k}" for k in range(40)] + ["", None]
    return [(k, rng.choice(["a", "b", None]), rng.choice(texts) if k % 3 else f"alone {k}", k % 5, "x") for k in range(900)] + [(7, "a", "other row, same id", 9, "y")]


SCHEMA = "row_id long, g string, text string, `odd.name` int, copies_ string"


@pytest.mark.parametrize("bits", [dedup.FILTER_BITS, 1 << 8, 64])
def test_first_row_of_each_text_stays(spark, rows, bits):
    """Also where every row passes the filter."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = dedup.dedup_exact(df, "text", ["g"], "row_id", bits).collect()
    least, copies = {}, Counter()
    for r in rows:
        copies[r[1], r[2]] += 1
        least[r[1], r[2]] = min(least.get((r[1], r[2]), r), r, key=lambda x: x[0])
    assert sorted(tuple(r) for r in got if r["g"] and r["text"] is not None) == sorted((*r, copies[k]) for k, r in least.items() if None not in k)
    assert Counter((r["g"], r["text"], r["copies"]) for r in got) == Counter((*k, n) for k, n in copies.items())
    assert df.columns == [c for c in dedup.dedup_exact(df, "text", ["g"], "row_id").columns if c != "copies"]


def test_the_filter_holds_its_keys_and_few_others(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("key"))
    bloom = dedup.bloom_filter(keys, "key", 1 << 20)
    assert keys.filter(~dedup.might_hold(bloom, F.col("key"), 1 << 20)).count() == 0
    others = spark.range(20_000, 60_000).select(F.xxhash64("id").alias("key"))
    assert others.filter(dedup.might_hold(bloom, F.col("key"), 1 << 20)).count() < 400
    empty = dedup.bloom_filter(keys.limit(0), "key", 1 << 10)
    assert keys.filter(dedup.might_hold(empty, F.col("key"), 1 << 10)).count() == 0


@pytest.mark.parametrize("bits", [dedup.FILTER_BITS, 64])
def test_overlap_counts_held_out_rows_known_to_train(spark, rows, bits):
    named = [(*r, ["train", "test", "val", None][r[0] % 4]) for r in rows]
    df = spark.createDataFrame(named, SCHEMA + ", split string")
    train = {(r[1], r[2]) for r in named if r[5] == "train"}
    want = {}
    for r in named:
        if r[5] in ("test", "val"):
            n, known = want.get((r[1], r[5]), (0, 0))
            want[r[1], r[5]] = n + 1, known + ((r[1], r[2]) in train)
    got = {(r["g"], r["split"]): (r["rows"], r["in_train"]) for r in dedup.split_overlap(df, "text", ["g"], bits=bits).collect()}
    assert got == want and any(known for _, known in want.values())


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA + ", split string")
    assert dedup.dedup_exact(df, "text", ["g"], "row_id").count() == 0 and dedup.split_overlap(df, "text", ["g"]).count() == 0
