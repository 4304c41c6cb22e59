"""Exact ranks, running totals and percentiles that never put one group into one task.

A plain ``row_number() over (partition by class order by ...)`` sorts a class in a single
task; with a class holding a third of 100 TB that task never ends. Here the order key is
cut into buckets by a *monotone* expression. Bucket sizes come from a pre-aggregated
count, their running sum gives each bucket its offset, and rows are ranked inside
(group, bucket) only. The result is the exact rank; the unit of work is one bucket.

``range_of`` cuts at borders drawn from the keys themselves, so sparse numbers, bursts and
keys with a constant leading part all make ranges of about equal size. A prefix of a hash is
a good bucket for a hash order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, StringType

from dragoman.functions.plan import through_table

ROWS_PER_BUCKET = 100_000
#: Ranges at most; beyond ROWS_PER_BUCKET times as many rows the ranges grow.
MAX_RANGES = 10_000
#: Keys drawn for each range; the size of a range then varies by about a quarter.
DRAWN_PER_RANGE = 16
#: Neighbouring bucket numbers of one block; sparse numbers make blocks of fewer buckets.
BUCKETS_PER_BLOCK = 10_000


def seq_bucket(seq: Column, rows: int = ROWS_PER_BUCKET) -> Column:
    """At most ``rows`` distinct values of a unique sequence number per bucket."""
    return F.floor(seq / rows)


def range_of(df: DataFrame, order: list[str], rows: int = ROWS_PER_BUCKET) -> Column | None:
    """Number of the range that a row's key falls in, or None where ``df`` has at most ``rows`` rows.

    ``order`` is unique and not null. A pass over the keys counts them; a second one draws
    ``DRAWN_PER_RANGE`` keys a range, of which every so-manieth becomes a border. The borders
    are a constant of the plan (``MAX_RANGES`` at most), found by bisection: rows do not move.
    """
    n = df.agg(F.count(F.lit(1))).first()[0]
    if n <= rows:
        return None
    ranges = min(-(-n // rows), MAX_RANGES)
    drawn = df.select(F.struct(*order).alias("k")).sample(min(1.0, ranges * DRAWN_PER_RANGE / n), seed=7)
    keys = drawn.agg(F.array_sort(F.collect_list("k")).alias("k")).select(
        F.filter("k", lambda _, i: i % DRAWN_PER_RANGE == DRAWN_PER_RANGE - 1).alias("k")).first()[0]
    if not keys:
        return None
    borders = {c: F.array(*[F.lit(k[c]) for k in keys]).cast(ArrayType(df.schema[c].dataType)) for c in order}

    def step(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        reached = F.struct(*[F.get(borders[c], middle).alias(c) for c in order]) <= F.struct(*order)
        open_ = at["low"] < at["high"]
        return F.struct(F.when(open_ & reached, middle + 1).otherwise(at["low"]).alias("low"),
                        F.when(open_ & ~reached, middle).otherwise(at["high"]).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(max(1, len(keys).bit_length())))
    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.lit(len(keys)).alias("high")), step, lambda at: at["low"])


def _offsets(df: DataFrame, groups: list[str], value: Column, buckets_per_block: int = BUCKETS_PER_BLOCK) -> DataFrame:
    """Sum of each bucket, of all buckets before it, and of its group, in two levels.

    Numbered buckets are summed inside blocks of neighbouring numbers, and blocks inside the group, so a
    task holds a block's buckets or a group's blocks. Prefixes of a hash are few and form one block.
    """
    per_bucket = df.groupBy(*groups, "_bucket").agg(F.sum(value).alias("_bucket_sum"))
    numbered = not isinstance(per_bucket.schema["_bucket"].dataType, StringType)
    blocked = per_bucket.withColumn("_block", F.floor(F.col("_bucket") / buckets_per_block) if numbered else F.lit(0).cast("bigint"))
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocked.groupBy(*groups, "_block").agg(F.sum("_bucket_sum").alias("_block_sum")).select(
        *groups, "_block",
        F.coalesce(F.sum("_block_sum").over(earlier), F.lit(0)).alias("_block_offset"),
        F.sum("_block_sum").over(whole).alias("_group_sum"))
    before = Window.partitionBy(*groups, "_block").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return blocked.join(blocks, [*groups, "_block"]).select(
        *groups, "_bucket",
        (F.col("_block_offset") + F.coalesce(F.sum("_bucket_sum").over(before), F.lit(0))).alias("_offset"),
        "_group_sum", "_bucket_sum",
    )


def ranked(df: DataFrame, groups: list[str], bucket: Column | None, order: list, out: str = "rank",
           total: str | None = None, below: Column | None = None) -> DataFrame:
    """Add the exact 1-based rank within ``groups`` (non-null) by ``order``.

    ``bucket`` must be monotone in ``order``; None ranks each group as a whole. ``below`` is a
    column of ``df``: buckets that start at or after it are dropped before any row is sorted,
    and so are ranks above it. ``total`` names an extra column with the group size.
    """
    if bucket is None:
        whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
        result = df.withColumn(out, F.row_number().over(whole.orderBy(*order)).cast("bigint"))
        if total:
            result = result.withColumn(total, F.count(F.lit(1)).over(whole))
        return result if below is None else result.filter(F.col(out) <= below)
    cut = df.withColumn("_bucket", bucket)
    joined = cut.join(_offsets(cut, groups, F.lit(1)), [*groups, "_bucket"])
    if below is not None:
        joined = joined.filter(F.col("_offset") < below)
    inside = Window.partitionBy(*groups, "_bucket").orderBy(*order)
    result = joined.withColumn(out, (F.col("_offset") + F.row_number().over(inside)).cast("bigint"))
    if below is not None:
        result = result.filter(F.col(out) <= below)
    if total:
        result = result.withColumn(total, F.col("_group_sum"))
    return result.drop("_bucket", "_offset", "_group_sum", "_bucket_sum")


def keys_at_ranks(df: DataFrame, groups: list[str], bucket: Column | None, order: list[str], ranks: dict[str, Column],
                  limits: DataFrame | None = None) -> DataFrame:
    """The order key (a struct of ``order``) found at given 1-based ranks, one row per group.

    ``ranks`` are expressions over ``_group_sum`` (rows of the group) and the columns of
    ``limits``, a dimension by group; ranks past the end mean the last row, ranks below 1
    give null. Only the buckets that hold a wanted rank are sorted. "The first n rows of a
    group" is then a comparison with this key: the rows themselves are neither shuffled
    nor sorted. A ``bucket`` of None ranks each group as a whole.
    """
    if bucket is None:
        bucket = F.lit(0)
    cut = df.select(*groups, *order, bucket.alias("_bucket"))
    offsets = _offsets(cut, groups, F.lit(1))
    if limits is not None:
        offsets = offsets.join(F.broadcast(limits), groups)
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), F.least(rank.cast("bigint"), F.col("_group_sum")).alias("rank"))
        for name, rank in ranks.items()])
    # at most one bucket per group and rank remains
    needed = (offsets.withColumn("_wanted", F.filter(wanted, lambda w: (w["rank"] > F.col("_offset")) & (
        w["rank"] <= F.col("_offset") + F.col("_bucket_sum"))))
        .filter(F.size("_wanted") > 0).select(*groups, "_bucket", "_offset", "_wanted"))
    inside = Window.partitionBy(*groups, "_bucket").orderBy(*order)
    found = (cut.join(F.broadcast(needed), [*groups, "_bucket"])
             .withColumn("_rank", F.col("_offset") + F.row_number().over(inside))
             .withColumn("_w", F.explode("_wanted")).filter(F.col("_w.rank") == F.col("_rank")))
    return found.groupBy(*groups).agg(*[
        F.max(F.when(F.col("_w.name") == name, F.struct(*order))).alias(name) for name in ranks])


def running_total(df: DataFrame, groups: list[str], bucket: Column, order: list, value: Column,
                  out: str = "running") -> DataFrame:
    """Add the exact inclusive running sum of ``value`` within ``groups`` by ``order``."""
    cut = df.withColumn("_bucket", bucket).withColumn("_value", value)
    joined = cut.join(_offsets(cut, groups, F.col("_value")), [*groups, "_bucket"])
    inside = (Window.partitionBy(*groups, "_bucket").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return joined.withColumn(out, F.col("_offset") + F.sum("_value").over(inside)).drop(
        "_bucket", "_value", "_offset", "_group_sum", "_bucket_sum")


#: Steps of the quantile grid that narrows a bracket; its sketch is ten times finer.
GRID = 1000


def exact_percentiles(df: DataFrame, groups: list[str], value: str, shares: dict[str, float],
                      rows: int = ROWS_PER_BUCKET) -> DataFrame:
    """Exact percentiles with linear interpolation, one row per group (non-null); null values do not count.

    Each wanted rank is held by a bracket of values, at first the whole group. Where a bracket
    holds more than ``rows`` different values, a mergeable quantile sketch of them gives a
    narrower one, whose exact counts confirm that the rank lies inside; a round leaves about
    six thousandths of the values, whatever their range or density. Then equal values are
    merged, so a hot value is one row, and only the brackets are ranked. ``percentile()``
    would build the whole value table of a group in one task.
    """
    if not groups:
        return exact_percentiles(df.withColumn("_all", F.lit(0)), ["_all"], value, shares, rows).drop("_all")
    values = df.filter(F.col(value).isNotNull()).select(*groups, F.col(value).alias("_v"))
    named = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(s)).alias("share")) for n, s in shares.items()])
    sizes = values.groupBy(*groups).agg(F.count(F.lit(1)).alias("_inside"))
    position = F.col("_w.share") * (F.col("_inside") - 1)
    kind = values.schema["_v"].dataType
    brackets = through_table(sizes.withColumn("_w", F.explode(named)).select(
        *groups, F.col("_w.name").alias("_name"), F.floor(position).alias("_first"), F.ceil(position).alias("_last"),
        (position - F.floor(position)).alias("_part"), F.lit(None).cast(kind).alias("_low"), F.lit(None).cast(kind).alias("_high"),
        F.lit(0).cast("bigint").alias("_below"), "_inside", F.col("_inside").alias("_different")), "brackets")
    while not brackets.filter(F.col("_different") > rows).isEmpty():
        narrowed = _narrowed(values, groups, brackets.filter(F.col("_different") > rows))
        brackets = through_table(brackets.filter(F.col("_different") <= rows).unionByName(narrowed), "brackets")
    merged = _inside(values, groups, brackets).groupBy(*groups, "_name", "_v").agg(
        F.count(F.lit(1)).alias("_n"), F.first("_first").alias("_first"), F.first("_last").alias("_last"),
        F.first("_part").alias("_part"), F.first("_below").alias("_below"))
    up_to = Window.partitionBy(*groups, "_name").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = merged.withColumn("_end", F.col("_below") + F.sum("_n").over(up_to))
    holds = lambda rank: (F.col(rank) < F.col("_end")) & (F.col(rank) >= F.col("_end") - F.col("_n"))
    at = lambda name, rank: F.max(F.when((F.col("_name") == name) & holds(rank), F.col("_v")))
    part = lambda name: F.max(F.when(F.col("_name") == name, F.col("_part")))
    return ends.filter(holds("_first") | holds("_last")).groupBy(*groups).agg(*[
        (at(n, "_first") + part(n) * (at(n, "_last") - at(n, "_first"))).alias(n) for n in shares])


def _inside(values: DataFrame, groups: list[str], brackets: DataFrame) -> DataFrame:
    """The values of each bracket; a row per bracket that holds it."""
    return values.join(brackets, groups).filter((F.col("_low").isNull() | (F.col("_v") >= F.col("_low"))) & (F.col("_high").isNull() | (F.col("_v") <= F.col("_high"))))


def _narrowed(values: DataFrame, groups: list[str], brackets: DataFrame) -> DataFrame:
    """Narrower brackets that still hold their ranks; one that cannot be narrowed counts as small."""
    key = [*groups, "_name"]
    inside = _inside(values, groups, brackets)
    grid = inside.groupBy(*key).agg(F.percentile_approx("_v", [k / GRID for k in range(GRID + 1)], 10 * GRID).alias("_grid"))
    step = lambda rank: (F.col(rank) - F.col("_below")) / F.col("_inside") * GRID
    low, high = F.floor(step("_first")) - 2, F.ceil(step("_last")) + 3
    tried = through_table(brackets.join(grid, key).withColumn("_to_low", F.when(low > 0, F.get("_grid", low.cast("int"))).otherwise(F.col("_low")))
                          .withColumn("_to_high", F.when(high < GRID, F.get("_grid", high.cast("int"))).otherwise(F.col("_high"))).drop("_grid"), "brackets")
    again = _inside(values, groups, tried)
    under, over = F.coalesce(F.col("_v") < F.col("_to_low"), F.lit(False)), F.coalesce(F.col("_v") > F.col("_to_high"), F.lit(False))
    counts = again.groupBy(*key).agg(F.count_if(under).alias("_under"), F.count_if(~under & ~over).alias("_left"),
                                     F.approx_count_distinct(F.when(~under & ~over, F.col("_v"))).alias("_distinct"))
    below = F.col("_below") + F.col("_under")
    good = (below <= F.col("_first")) & (F.col("_last") < below + F.col("_left"))
    shrunk = good & (F.col("_left") < F.col("_inside"))
    pick = lambda new, old: F.when(good, new).otherwise(F.col(old)).alias(old)
    return tried.join(counts, key).select(
        *key, "_first", "_last", "_part", pick(F.col("_to_low"), "_low"), pick(F.col("_to_high"), "_high"), pick(below, "_below"),
        pick(F.col("_left"), "_inside"), F.when(shrunk, F.least("_distinct", "_left")).otherwise(0).alias("_different"))
