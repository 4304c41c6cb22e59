import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dragoman.functions import ranking
from dragoman.functions.ranking import _offsets, exact_percentiles, keys_at_ranks, range_of, ranked, running_total, seq_bucket
from dragoman.functions.skew import salted_left_join
from dragoman.operators import split


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group."""
    rng = random.Random(1)
    rows = [(i, "hot" if i % 3 == 0 else f"g{rng.randint(0, 9)}", rng.randint(0, 5)) for i in range(3000)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "seq bigint, g string, v int").repartition(7)


def test_ranks_and_totals_are_exact_across_buckets(skewed):
    rows, df = skewed
    seen, total, want_rank, want_sum = {}, {}, {}, {}
    for seq, g, v in sorted(rows):
        seen[g] = seen.get(g, 0) + 1
        total[g] = total.get(g, 0) + v
        want_rank[seq], want_sum[seq] = seen[g], total[g]
    got = ranked(df, ["g"], seq_bucket(F.col("seq"), 50), ["seq"], total="n").collect()
    assert {r["seq"]: r["rank"] for r in got} == want_rank
    assert {r["g"]: r["n"] for r in got} == seen
    sums = running_total(df, ["g"], seq_bucket(F.col("seq"), 50), ["seq"], F.col("v")).collect()
    assert {r["seq"]: r["running"] for r in sums} == want_sum


@pytest.mark.parametrize("spacing", [1, 97_003])
def test_offsets_in_two_levels_hold_few_buckets_a_task(skewed, spacing):
    """Dense and sparse numbers: offsets equal the plain running sum, whatever the size of a block."""
    rows, df = skewed
    cut = df.withColumn("_bucket", F.floor(F.col("seq") * spacing / 10))
    plain, before, totals = {}, {}, {}
    for seq, g, v in sorted(rows):
        plain.setdefault((g, seq * spacing // 10), before.get(g, 0))
        before[g] = before.get(g, 0) + v
        totals[g] = totals.get(g, 0) + v
    for size in (3, 50, 10_000):
        got = _offsets(cut, ["g"], F.col("v"), size).collect()
        assert {(r["g"], r["_bucket"]): r["_offset"] for r in got} == plain
        assert all(r["_group_sum"] == totals[r["g"]] for r in got)
        per_block = {}
        for r in got:
            per_block[r["g"], r["_bucket"] // size] = per_block.get((r["g"], r["_bucket"] // size), 0) + 1
        assert max(per_block.values()) <= size


def test_rank_limit_keeps_exactly_the_first_rows(skewed):
    rows, df = skewed
    capped = ranked(df.withColumn("room", F.when(F.col("g") == "hot", 123).otherwise(7)), ["g"],
                    seq_bucket(F.col("seq"), 40), ["seq"], below=F.col("room")).collect()
    hot = sorted(r["seq"] for r in capped if r["g"] == "hot")
    assert hot == sorted(s for s, g, _ in rows if g == "hot")[:123]
    assert all(sum(r["g"] == g for r in capped) == 7 for g in {g for _, g, _ in rows} - {"hot"})


def test_percentiles_match_linear_interpolation(spark):
    rng = np.random.default_rng(5)
    groups = {"a": rng.gamma(2, 3, 1001), "b": np.full(400, 2.5), "c": np.array([7.0]), "d": np.r_[np.zeros(900), rng.random(100) * 50]}
    df = spark.createDataFrame([(g, float(x)) for g, xs in groups.items() for x in xs], "g string, x double")
    for rows in (100_000, 60, 1):
        got = exact_percentiles(df, ["g"], "x", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, rows).collect()
        assert len(got) == 4
        for r in got:
            assert np.allclose([r["p50"], r["p95"], r["p99"]], np.percentile(groups[r["g"]], [50, 95, 99]), rtol=1e-12)


@pytest.mark.parametrize("kind", ["dense", "wide", "two values", "ties at the border"])
def test_brackets_stay_small_whatever_the_density(spark, monkeypatch, kind):
    """All values within 0.0002, a range of 10^9, and hot values: exact, with few different values ranked at last."""
    rng = np.random.default_rng(8)
    xs = {"dense": 1 + rng.random(60_000) * 0.0002, "wide": rng.lognormal(0, 7, 60_000) * 1000, "two values": np.repeat([3.0, 4.0], 30_000),
          "ties at the border": np.r_[np.full(30_000, 2.0), 2 + rng.random(30_000)]}[kind]
    df = spark.createDataFrame(pd.DataFrame({"g": 1, "x": rng.permutation(xs)}))
    seen, inside = [], ranking._inside
    monkeypatch.setattr(ranking, "_inside", lambda v, g, b: seen.append(inside(v, g, b)) or seen[-1])
    shares = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    got = exact_percentiles(df, ["g"], "x", shares, 500).first()
    assert np.allclose([got[n] for n in shares], np.quantile(xs, list(shares.values())), rtol=1e-12)
    ranked_at_last = seen[-1].groupBy("_name").agg(F.count_distinct("_v").alias("n")).agg(F.max("n")).first()[0]
    assert ranked_at_last <= 500


def test_percentiles_without_groups_and_without_values(spark):
    df = spark.createDataFrame([(None,), (4.0,), (2.0,)], "x double")
    assert exact_percentiles(df, [], "x", {"p50": 0.5}).collect() == [(3.0,)]
    assert exact_percentiles(df.filter("x > 9"), [], "x", {"p50": 0.5}).collect() == []


def keys_of(kind):
    """Order keys (a, b): sparse times with one dense burst, one constant leading key, huge gaps."""
    rng = random.Random(4)
    if kind == "burst":
        return [(rng.randrange(10**15), k) for k in range(2000)] + [(77 * 10**12 + k, k) for k in range(4000)]
    if kind == "constant":
        return [(5, k) for k in range(6000)]
    return [(k**5 - 10**15, k) for k in range(6000)]


@pytest.mark.parametrize("kind", ["burst", "constant", "gaps"])
def test_ranges_are_even_and_ranks_exact(spark, kind):
    keys = keys_of(kind)
    rows = [("hot" if i % 3 == 0 else f"g{i % 7}", a, b, i % 4) for i, (a, b) in enumerate(random.Random(1).sample(keys, len(keys)))]
    df = spark.createDataFrame(rows, "g string, a bigint, b bigint, v int").repartition(5)
    bucket = range_of(df, ["a", "b"], 200)
    sizes = [r["count"] for r in df.groupBy(bucket.alias("bucket")).count().collect()]
    assert 20 <= len(sizes) <= 40 and max(sizes) <= 600
    seen, total, rank, running = {}, {}, {}, {}
    for g, a, b, v in sorted(rows, key=lambda r: r[1:3]):
        seen[g], total[g] = seen.get(g, 0) + 1, total.get(g, 0) + v
        rank[a, b], running[a, b] = seen[g], total[g]
    assert {(r["a"], r["b"]): r["rank"] for r in ranked(df, ["g"], bucket, ["a", "b"]).collect()} == rank
    assert {(r["a"], r["b"]): r["running"] for r in running_total(df, ["g"], bucket, ["a", "b"], F.col("v")).collect()} == running
    for cut in (bucket, None):
        found = keys_at_ranks(df, ["g"], cut, ["a", "b"], {"third": F.lit(3), "half": F.floor(F.col("_group_sum") / 2)}).collect()
        assert {r["g"]: (rank[tuple(r["third"])], rank[tuple(r["half"])]) for r in found} == {g: (3, n // 2) for g, n in seen.items()}


def test_small_tables_are_one_range(spark):
    df = spark.range(50).withColumn("g", F.col("id") % 3)
    assert range_of(df, ["id"]) is None
    got = ranked(df, ["g"], None, ["id"], total="n", below=F.lit(4)).collect()
    assert sorted((r["g"], r["rank"], r["n"]) for r in got) == [(g, k, n) for g, n in ((0, 17), (1, 17), (2, 16)) for k in range(1, 5)]


def test_salted_join_equals_plain_join(spark):
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 50}") for i in range(900)] + [(1000, None)], "id int, k string")
    dim = spark.createDataFrame([("hot", 1), ("k3", 2), ("k6", 3)], "k string, v int")
    plain = sorted((r["id"], r["v"] or 0) for r in facts.join(dim, "k", "left").collect())
    salted = sorted((r["id"], r["v"] or 0) for r in salted_left_join(facts, dim, "k", ["id"], hot_rows=100, salts=5).collect())
    assert salted == plain


def test_checkpoint_rule_equals_the_sequential_loop(spark):
    rng = random.Random(2)
    arrivals = [(i * 3, rng.choice([0, 1, 5, 20, 70, 600])) for i in range(400)]
    held = flush = 0
    want = {}
    for seq, n in arrivals:
        held += n
        want[seq] = (flush, held >= 500)
        if held >= 500:
            held, flush = 0, flush + 1
    df = spark.createDataFrame(arrivals, "seq bigint, n bigint").repartition(5)
    got = split.checkpoint_batches(df, "seq", "n", rows_per_bucket=100).collect()
    assert {r["seq"]: (r["flush_no"], r["flushes"]) for r in got} == want


def test_split_is_a_partition_with_exact_sizes(spark):
    df = spark.range(5000).withColumn("c", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7 + 2).cast("int"))
    got = split.stratified_split(df, "id", "c")
    assert got.count() == got.select("id").distinct().count() == 5000
    per = got.groupBy("c").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t"), F.count_if(F.col("split") == "val").alias("v"))
    for r in per.collect():
        assert abs(r["t"] - 0.05 * r["n"]) <= 0.5 and abs(r["v"] - 0.10 * r["n"]) <= 0.5
    again = {r["id"]: r["split"] for r in split.stratified_split(df.repartition(11), "id", "c").collect()}
    assert again == {r["id"]: r["split"] for r in got.collect()}
