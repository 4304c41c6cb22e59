"""Structured Streaming jobs: classify, refine, quota, usage, latency, checkpoint batches.

Every job takes a streaming DataFrame and returns one (or starts a sink), so the source may
be files, a broker or anything Spark reads. The column logic is that of the batch operators.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructField, StructType

from dragoman import dims
from dragoman.functions.plan import bind_once
from dragoman.operators import cascade, refine, routing
from dragoman.operators.gate import noise_rule
from dragoman.session import shared_folder
from dragoman.sources.sinks import write_examples


def file_stream(spark: SparkSession, folder: str, schema, name: str = "*.parquet", max_files: int = 1000) -> DataFrame:
    return (spark.readStream.schema(schema).option("pathGlobFilter", name)
            .option("maxFilesPerTrigger", max_files).parquet(folder))


def run_available(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there and stop; a later run with the same checkpoint goes on from it."""
    query = (stream.writeStream.format("parquet").outputMode(mode).option("path", out)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def run_to_table(stream: DataFrame, purpose: str, mode: str = "append") -> DataFrame:
    """Run to completion into a fresh folder of the shared checkpoint area and read it back."""
    spark = stream.sparkSession
    base = shared_folder(spark, purpose)
    run_available(stream, f"{base}/out", f"{base}/checkpoint", mode)
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def run_latest(stream: DataFrame, purpose: str, keys: list[str]) -> DataFrame:
    """Run an updating aggregate and return its last state per key.

    Each micro-batch writes its updates under its id; a replay overwrites its own folder.
    """
    spark = stream.sparkSession
    base = shared_folder(spark, purpose)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{base}/out/part={batch_id}")

    query = (stream.writeStream.outputMode("update").option("checkpointLocation", f"{base}/checkpoint")
             .trigger(availableNow=True).foreachBatch(store).start())
    query.awaitTermination()
    updates = spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/out")
    values = [c for c in stream.columns if c not in keys]
    latest = updates.groupBy(*keys).agg(F.max_by(F.struct(*values), "_batch").alias("_v"))
    return latest.select(*keys, "_v.*")


def classify_stream(messages: DataFrame, text: str = "text") -> DataFrame:
    """Messages in, gated, labelled and routed rows out. Stateless."""
    checked = bind_once(messages, {"gate_rule": noise_rule(F.col(text))})
    # a gated text reaches no pattern, so matched and rule_no agree with the fixed answer
    open_text = checked.withColumn("_open", F.when(F.col("gate_rule").isNull(), F.col(text)))
    labelled = cascade.regex_classify(open_text, "_open").drop("_open")
    gated = F.col("gate_rule").isNotNull()
    fixed = labelled.withColumns({
        "label": F.when(gated, "noise_gibberish").otherwise(F.col("label")),
        "tier": F.when(gated, "1").otherwise(F.col("tier"))})
    return routing.route(fixed)


def refine_stream(responses: DataFrame, folder: str, checkpoint: str, counts: DataFrame | None = None) -> StreamingQuery:
    """Raw answers in, tagged examples appended per class; replays of a micro-batch add nothing.

    ``counts(class_id, existing, target)`` is what the classes hold before the stream starts. Each
    micro-batch skips mixed-mode items of classes that are complete by then, what earlier
    micro-batches appended included. The running counts lie beside the examples, a row per class
    under the micro-batch's id: a replay, or a run that goes on after a restart, reads those of the
    micro-batch before it.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if counts is None:
            write_examples(refine.refine(batch), folder, batch_id=batch_id)
            return
        none = counts.select("class_id", F.lit(0).cast("bigint").alias("taken"))
        before = spark.read.schema(none.schema).parquet(f"{folder}-counts/batch={batch_id - 1}") if batch_id else none
        held = counts.join(before, "class_id", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("bigint")))
        done = held.filter(F.col("existing") + F.col("taken") >= F.col("target")).select("class_id")
        write_examples(refine.refine(batch, done=done), folder, batch_id=batch_id)
        written = spark.read.option("recursiveFileLookup", "true").schema("intent_class_id int").json(f"{folder}/batch={batch_id}")
        new = written.groupBy(F.col("intent_class_id").alias("_class")).agg(F.count(F.lit(1)).alias("new"))
        held.join(new, F.col("class_id") == F.col("_class"), "left").select(
            "class_id", (F.col("taken") + F.coalesce("new", F.lit(0))).cast("bigint").alias("taken"),
        ).coalesce(1).write.mode("overwrite").parquet(f"{folder}-counts/batch={batch_id}")  # a row per class

    return (responses.writeStream.option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).foreachBatch(store).start())


def usage_stream(calls: DataFrame) -> DataFrame:
    """Calls per UTC day and model; counters start anew with each day's window.

    Every call counts, however late it comes: there is no watermark. The state is days times models.
    """
    daily = (calls.groupBy(F.window("ts", "1 day").alias("w"), "provider", "model")
             .agg(F.count(F.lit(1)).alias("calls"), F.count_if(~F.col("ok")).alias("failed")))
    return daily.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "provider", "model", "calls", "failed")


#: Ratio of neighbouring bucket borders of the latency sketch: a percentile is off by one part in a hundred at most.
SKETCH_RATIO = 1.02


def sketch_bucket(value: Column) -> Column:
    """Bucket of a value: i holds those in (ratio^(i-1), ratio^i]; values up to zero share the least, null has none."""
    return F.when(value <= 0, F.lit(-(1 << 30))).otherwise(F.ceil(F.log(value) / math.log(SKETCH_RATIO))).cast("int")


def sketch_value(bucket: Column) -> Column:
    """A value within one part in a hundred of all values of a bucket; 0 for the least."""
    return F.when(bucket == -(1 << 30), 0.0).otherwise(F.pow(F.lit(SKETCH_RATIO), bucket) * (2 / (1 + SKETCH_RATIO)))


def latency_panes(predictions: DataFrame, pane: str = "1 day") -> DataFrame:
    """Counts per pane of time, classifier and sketch bucket: the state of rolling latency.

    Counts add up, so panes merge into windows of any length, and every row counts, however late it
    comes: there is no watermark. The state is panes times classifiers times buckets in use, some
    hundreds; a row belongs to one pane, however many windows slide over it.
    """
    return predictions.groupBy(F.window("ts", pane).alias("w"), "classifier", sketch_bucket(F.col("latency_ms")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("latency_ms").alias("sum_ms"), F.count("latency_ms").alias("timed"),
        F.count_if("matched").alias("covered")).select(F.col("w.start").alias("pane_start"), "classifier", "bucket", "rows", "sum_ms", "timed", "covered")


PANE_KEYS = ["pane_start", "classifier", "bucket"]


def latency_windows(panes: DataFrame, pane_s: int, panes_per_window: int = 1, panes_per_slide: int = 1, share: float = 0.95) -> DataFrame:
    """Mean and p95 latency and coverage per window and classifier, from panes.

    Windows start at multiples of the slide. The bucket of p95 is that of the value ranked
    ceil(share * n), exactly; the value shown lies within one part in a hundred of it.
    """
    number = F.floor(F.unix_timestamp("pane_start") / pane_s)
    starts = F.filter(F.sequence(number - (panes_per_window - 1), number), lambda k: k % panes_per_slide == 0)
    spread = panes.withColumn("_start", F.explode(starts))
    merged = spread.groupBy("_start", "classifier", "bucket").agg(*[F.sum(c).alias(c) for c in ("rows", "sum_ms", "timed", "covered")])
    up_to = Window.partitionBy("_start", "classifier").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("_start", "classifier")  # a row per bucket
    hit = F.col("bucket").isNotNull() & (F.sum("timed").over(up_to) >= F.ceil(F.sum("timed").over(whole) * F.lit(share)))
    ranked = merged.withColumn("_hit", F.when(hit, F.col("bucket")))
    return ranked.groupBy("_start", "classifier").agg(
        F.sum("rows").alias("rows"), (F.sum("sum_ms") / F.sum("timed")).alias("avg_ms"), sketch_value(F.min("_hit")).alias("p95_ms"),
        F.sum("covered").alias("covered")).select(
            F.date_format(F.timestamp_seconds(F.col("_start") * pane_s), "yyyy-MM-dd HH:mm").alias("window_start"),
            "classifier", "rows", "avg_ms", "p95_ms", "covered")


class _Quota(StatefulProcessor):
    """Accept the first rows of a class by arrival; the state is their arrival numbers, at most ``limit``."""

    def __init__(self, limit: int, key: str, seq: str, columns: list[str]):
        self.limit, self.key, self.seq, self.columns = limit, key, seq, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.accepted = handle.getValueState("accepted", StructType([StructField("seqs", BinaryType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        held = self.accepted.get() if self.accepted.exists() else None
        old = np.frombuffer(held[0], "<i8") if held else np.zeros(0, "<i8")
        new = None
        for pdf in rows:
            fresh = pdf[~pdf[self.seq].isin(old)]
            new = fresh if new is None else pd.concat([new, fresh])
            new = new.drop_duplicates(self.seq).nsmallest(self.limit, self.seq)
        if new is None or not len(new):
            return
        first = np.sort(np.concatenate([old, new[self.seq].to_numpy("<i8")]))[:self.limit]
        self.accepted.update((first.astype("<i8").tobytes(),))
        taken = new[new[self.seq].isin(first)]
        if len(taken):
            yield taken.assign(accepted=True)
        gone = old[~np.isin(old, first)]
        if len(gone):
            back = pd.DataFrame({c: pd.Series([None] * len(gone), dtype=object) for c in self.columns})
            back[self.key], back[self.seq] = key[0], gone
            yield back.assign(accepted=False)

    def close(self) -> None:
        pass


def quota_stream(examples: DataFrame, limit: int, key: str = "intent_class_id", seq: str = "row_id") -> DataFrame:
    """The first ``limit`` rows of each class by arrival number, across micro-batches, as changes.

    ``seq`` is a unique bigint; a number that comes again is not counted twice. A row that arrives late
    but is numbered before an accepted one takes its place: it is emitted with ``accepted`` true,
    and the number that falls out with false and its other columns null. ``accepted_rows`` gives the
    net result. A class's state is its accepted numbers, 8 bytes each. No task ever needs to forward
    more than its first ``limit`` rows of a class, so they are cut before the shuffle.
    """
    def first_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf])
            held = held.sort_values(seq).groupby(key, sort=False, dropna=False).head(limit)
        if held is not None:
            yield held

    early = examples.mapInPandas(first_rows, examples.schema)
    out = StructType([*examples.schema.fields, StructField("accepted", BooleanType())])
    return early.groupBy(key).transformWithStateInPandas(
        statefulProcessor=_Quota(limit, key, seq, examples.columns), outputStructType=out, outputMode="Append", timeMode="None")


def accepted_rows(changes: DataFrame, seq: str = "row_id") -> DataFrame:
    """The rows that stay accepted; a number that fell out never comes back."""
    gone = changes.filter("not accepted").select(seq)
    return changes.filter("accepted").drop("accepted").join(gone, seq, "left_anti").select(*[c for c in changes.columns if c != "accepted"])


class _Checkpoint(StatefulProcessor):
    """The exact flush rule per key; the state is the buffered rows and the next flush number."""

    def __init__(self, every: int):
        self.every = every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buffer = handle.getValueState("buffer", StructType([
            StructField("buffered", LongType()), StructField("flush_no", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        held = self.buffer.get() if self.buffer.exists() else None
        buffered, flush_no = (int(held[0]), int(held[1])) if held else (0, 0)
        # a micro-batch may deliver a key's arrivals out of order
        arrivals = pd.concat(list(rows)).sort_values("seq")
        numbers = []
        for added in arrivals["rows"]:
            buffered += int(added)
            numbers.append(flush_no)
            if buffered >= self.every:
                buffered, flush_no = 0, flush_no + 1
        self.buffer.update((buffered, flush_no))
        yield arrivals.assign(flush_no=numbers)[["shard", "seq", "rows", "flush_no"]]

    def close(self) -> None:
        pass


def checkpoint_stream(arrivals: DataFrame, every: int = dims.CHECKPOINT_ROWS) -> DataFrame:
    """Number the flush of each arriving batch ``(shard, seq, rows)``, one buffer per shard.

    A shard is one writer's buffer: its arrivals per micro-batch are bounded by the trigger.
    """
    out = "shard int, seq bigint, rows bigint, flush_no bigint"
    return arrivals.groupBy("shard").transformWithStateInPandas(
        statefulProcessor=_Checkpoint(every), outputStructType=out, outputMode="Append", timeMode="None")
