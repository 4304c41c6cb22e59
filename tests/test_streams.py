import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dragoman.operators import refine, split
from dragoman.plans import views
from dragoman.streaming import jobs


@pytest.mark.parametrize("max_files", [1, 3, 100])
def test_quota_accepts_the_first_by_arrival(spark, tmp_path, max_files):
    """Files in reverse order, a class with a third of all rows, numbers that come twice: equal to the batch operator."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 5 + 2)).cast("int").alias("intent_class_id"),
                                    F.col("id").alias("row_id"), F.concat(F.lit("t"), "id").alias("text"))
    for low in (2000, 1000, 0):
        rows.filter(F.col("row_id").between(low, low + 999)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    rows.filter("row_id < 700").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.file_stream(spark, str(tmp_path / "in"), rows.schema, max_files=max_files)
    got = jobs.accepted_rows(jobs.run_to_table(jobs.quota_stream(stream, 250), "quota-test"))
    limits = rows.select("intent_class_id").distinct().withColumn("remaining", F.lit(250))
    want = split.quota_cap(rows, limits, "row_id", ["row_id"]).select(*got.columns)
    assert got.count() == want.count() == 1500 and got.exceptAll(want).count() == 0


def test_refining_resumes_and_equals_batch(spark, sf_dir, tmp_path):
    raw = views.raw_responses(spark, sf_dir)
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for part in (0, 1):  # the second half arrives after the first run has ended
        raw.filter(F.col("response_id") % 2 == part).write.mode("append").parquet(source)
        jobs.refine_stream(jobs.file_stream(spark, source, raw.schema), out, checkpoint).awaitTermination()
    written = spark.read.option("recursiveFileLookup", "true").schema("response_id bigint, item_no int, text string, generated_by string").json(out)
    batch = refine.refine(raw).select("response_id", "item_no", "text", "generated_by")
    assert written.count() == batch.count() and written.exceptAll(batch).count() == 0


def test_complete_classes_are_skipped_in_later_micro_batches(spark, sf_dir, tmp_path):
    """Counts grow while the stream runs and over a restart; equal to a loop over the answers file by file."""
    raw = views.raw_responses(spark, sf_dir).persist()
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    held = spark.createDataFrame([(k, 0, 6 if k % 2 else 10**6) for k in range(1, 23)], "class_id int, existing bigint, target bigint")
    taken, want = {k: 0 for k in range(1, 23)}, []
    checked = refine.verify_responses(raw).filter("status = 'valid'").select("response_id", "item_no", "class_id", "expected_class_id").collect()
    for part in range(3):
        raw.filter(F.col("response_id") % 3 == part).coalesce(1).write.mode("append").parquet(source)
        done = {k for k in taken if k % 2 and taken[k] >= 6}
        for r in checked:
            if r["response_id"] % 3 == part and (r["expected_class_id"] is not None or r["class_id"] not in done):
                taken[r["class_id"]] += 1
                want.append((r["response_id"], r["item_no"]))
        for _ in range(2):  # the second start finds nothing new
            jobs.refine_stream(jobs.file_stream(spark, source, raw.schema, max_files=1), out, checkpoint, held).awaitTermination()
    got = spark.read.option("recursiveFileLookup", "true").schema("response_id bigint, item_no int").json(out).collect()
    assert sorted(tuple(r) for r in got) == sorted(want) and len(want) < len(checked)


def test_sliding_latency_windows(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01 00:10:00", 1.0), ("2024-01-01 00:50:00", 3.0), ("2024-01-01 01:10:00", 5.0), ("2024-01-01 01:11:00", None)],
                                 "ts string, latency_ms double").select(F.col("ts").cast("timestamp").alias("ts"), F.lit("main").alias("classifier"), F.lit(True).alias("matched"), "latency_ms")
    rows.write.parquet(str(tmp_path / "in"))
    stream = jobs.file_stream(spark, str(tmp_path / "in"), rows.schema)
    panes = jobs.run_latest(jobs.latency_panes(stream, "30 minutes"), "sliding", jobs.PANE_KEYS)
    got = {r["window_start"][11:]: r for r in jobs.latency_windows(panes, 1800, 2).collect()}
    assert {k: r["avg_ms"] for k, r in got.items()} == {"23:30": 1.0, "00:00": 2.0, "00:30": 4.0, "01:00": 5.0}
    assert {k: r["rows"] for k, r in got.items()} == {"23:30": 1, "00:00": 2, "00:30": 3, "01:00": 2}
    hourly = {r["window_start"][11:]: r["rows"] for r in jobs.latency_windows(panes, 1800, 2, 2).collect()}
    assert hourly == {"00:00": 2, "01:00": 2}


def test_sketched_p95_is_within_its_error(spark, tmp_path):
    rng = np.random.default_rng(3)
    xs = {"wide": rng.lognormal(0, 5, 5000), "narrow": 7 + rng.random(3000) * 1e-6, "zeros": np.r_[np.zeros(99), 3.0], "below": -rng.random(50)}
    rows = spark.createDataFrame(pd.DataFrame([(k, float(x)) for k, v in xs.items() for x in rng.permutation(v)], columns=["classifier", "latency_ms"])).select(
        F.timestamp_seconds(F.lit(1704067200)).alias("ts"), "classifier", F.lit(False).alias("matched"), "latency_ms")
    rows.repartition(5).write.parquet(str(tmp_path / "in"))
    stream = jobs.file_stream(spark, str(tmp_path / "in"), rows.schema, max_files=1)
    panes = jobs.run_latest(jobs.latency_panes(stream), "sketch", jobs.PANE_KEYS)
    for r in jobs.latency_windows(panes, 86_400).collect():
        x = np.sort(xs[r["classifier"]])
        exact = max(0.0, x[int(np.ceil(0.95 * len(x))) - 1])
        assert abs(r["p95_ms"] - exact) <= 0.0101 * exact and r["rows"] == len(x)


def test_late_rows_are_counted(spark, tmp_path):
    days = spark.range(1000).select(F.timestamp_seconds(1704067200 + F.col("id") * 2600).alias("ts"), F.lit("p").alias("provider"), F.lit("m").alias("model"), F.lit(True).alias("ok"))
    for low, high in ((21, 31), (11, 20), (1, 10)):  # the latest first, a file for each micro-batch
        days.filter(F.dayofmonth("ts").between(low, high)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.file_stream(spark, str(tmp_path / "in"), days.schema, max_files=1)
    got = jobs.run_latest(jobs.usage_stream(stream), "late", ["day", "provider", "model"])
    assert got.agg(F.sum("calls")).first()[0] == 1000
