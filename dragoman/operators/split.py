"""Quota caps, checkpoint batches and the stratified split, all without whole-group sorts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from dragoman import dims
from dragoman.functions.plan import bind_once
from dragoman.functions.ranking import ROWS_PER_BUCKET, keys_at_ranks, range_of, running_total, seq_bucket


def quota_cap(examples: DataFrame, remaining: DataFrame, seq: str, order: list[str],
              rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The first ``remaining`` rows of each class by arrival.

    ``remaining(intent_class_id, remaining)`` is a dimension. ``seq`` is the arrival number,
    leading in the unique ``order``. The last key a class may accept is found first; keeping
    rows up to it is a filter.
    """
    cls = "intent_class_id"
    last = keys_at_ranks(examples, [cls], range_of(examples, order, rows_per_bucket), order,
                         {"_last": F.col("remaining")}, remaining.filter(F.col("remaining") > 0))
    return examples.join(F.broadcast(last), cls).filter(F.struct(*order) <= F.col("_last")).drop("_last")


def stratified_split(examples: DataFrame, row_id: str, stratum: str, seed: int = 42,
                     test_share: float = dims.TEST_SHARE, val_share: float = dims.VAL_SHARE) -> DataFrame:
    """Add ``split`` (test/val/train) with exact shares per stratum, by a seeded hash order.

    The hash keys where test and validation end are found per stratum (from the few hash
    buckets that hold them); each row is then placed by comparing its own hash. The rows are
    not shuffled, however large a stratum is. Strata are a dimension. The examples are read
    three times (two narrow passes and the result), so they should be a stored table.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.col(row_id).cast("string")))
    hashed = bind_once(examples, {"_h": digest})
    n_test = F.round(F.col("_group_sum") * F.lit(test_share))
    n_val = F.round(F.col("_group_sum") * F.lit(val_share))
    ends = keys_at_ranks(hashed, [stratum], F.substring("_h", 1, 4), ["_h", row_id], {"_test": n_test, "_val": n_test + n_val})
    key = F.struct("_h", row_id)
    split = F.when(key <= F.col("_test"), "test").when(key <= F.col("_val"), "val").otherwise("train")
    return hashed.join(F.broadcast(ends), stratum, "left").withColumn("split", split).drop("_h", "_test", "_val")


def checkpoint_batches_even(arrivals: DataFrame, keys: list[str], seq: str, rows: str,
                            every: int = dims.CHECKPOINT_ROWS, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Flush number by position: ``floor((running - 1) / every)``.

    Differs from the exact rule: the buffer there restarts at zero after a flush, here the
    overshoot counts towards the next batch.
    """
    summed = running_total(arrivals, keys, seq_bucket(F.col(seq), rows_per_bucket), [F.col(seq)], F.col(rows))
    return summed.withColumn("flush_no", F.floor((F.greatest(F.col("running"), F.lit(1)) - 1) / every))


def checkpoint_batches(arrivals: DataFrame, seq: str, rows: str, every: int = dims.CHECKPOINT_ROWS,
                       rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Exact flush rule: add a batch, flush when the buffer holds ``every`` rows, restart at zero.

    The rule is sequential, but a run of arrivals is only a function from the rows buffered
    before it (0 .. every-1) to the rows buffered after it and the flushes within. Buckets
    of arrivals get that table in parallel; composing the tables is one small ordered
    pass (a row per bucket); then every bucket is replayed in parallel from its known
    start. Adds ``flush_no`` (0-based, of the flush that writes the batch) and ``flushes``
    (whether the batch triggers it). ``seq`` must be unique.
    """
    cut = arrivals.withColumn("_bucket", seq_bucket(F.col(seq), rows_per_bucket))

    def table(key, pdf: pd.DataFrame) -> pd.DataFrame:
        state, flushes = np.arange(every), np.zeros(every, dtype=np.int64)
        for added in pdf.sort_values("_seq")["_rows"].to_numpy():
            state = state + added
            full = state >= every
            flushes += full
            state = np.where(full, 0, state)
        return pd.DataFrame({"_bucket": [key[0]], "after": [state.tolist()], "flushes": [flushes.tolist()]})

    slim = cut.select("_bucket", F.col(seq).cast("bigint").alias("_seq"), F.col(rows).cast("bigint").alias("_rows"))
    tables = slim.groupBy("_bucket").applyInPandas(table, "_bucket bigint, after array<bigint>, flushes array<bigint>")

    def compose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buffered = flushed = 0
        for pdf in batches:
            out = []
            for bucket, after, flushes in zip(pdf["_bucket"], pdf["after"], pdf["flushes"]):
                out.append((bucket, buffered, flushed))
                flushed += int(flushes[buffered])
                buffered = int(after[buffered])
            yield pd.DataFrame(out, columns=["_bucket", "_start", "_flushed"])

    starts = tables.repartition(1).sortWithinPartitions("_bucket").mapInPandas(
        compose, "_bucket bigint, _start bigint, _flushed bigint")

    def replay(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_seq")
        buffered, flush_no = int(pdf["_start"].iloc[0]), int(pdf["_flushed"].iloc[0])
        numbers, hits = [], []
        for added in pdf["_rows"]:
            buffered += int(added)
            numbers.append(flush_no)
            hits.append(buffered >= every)
            if buffered >= every:
                buffered, flush_no = 0, flush_no + 1
        return pd.DataFrame({"_seq": pdf["_seq"], "rows": pdf["_rows"], "flush_no": numbers, "flushes": hits})

    return (slim.join(starts, "_bucket").groupBy("_bucket")
            .applyInPandas(replay, "_seq bigint, rows bigint, flush_no bigint, flushes boolean")
            .withColumnRenamed("_seq", seq))
