"""Sinks: example files per class, and the benchmark report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dragoman import dims


def with_class_file(examples: DataFrame) -> DataFrame:
    return examples.withColumn("class_file", dims.class_file(F.col("intent_class_id"), F.col("intent_class_label")))


def write_examples(examples: DataFrame, folder: str, batch_id: int | None = None) -> None:
    """Append examples, one folder per class; classes without new rows are not touched.

    The rebalance hint gathers a class into few files and lets the adaptive planner split a
    class that is far larger than the others over as many tasks as it needs. With
    ``batch_id`` the write goes to its own folder and replaces it, so a replayed micro-batch
    adds nothing.
    """
    rows = with_class_file(examples).hint("rebalance", "class_file")
    target = folder if batch_id is None else f"{folder}/batch={batch_id}"
    rows.write.mode("append" if batch_id is None else "overwrite").partitionBy("class_file").json(target)


def benchmark_report(overall: DataFrame, by_category: DataFrame, run_at: str) -> DataFrame:
    """One row with the nested JSON summary of a benchmark run.

    Its inputs are aggregates: one overall row and one row per category.
    """
    categories = by_category.agg(F.array_sort(F.collect_list(F.struct(
        "category", *[c for c in by_category.columns if c != "category"])))).scalar()
    whole = overall.select(F.struct(*overall.columns).alias("overall"), categories.alias("by_category"))
    return whole.select(F.to_json(F.struct(F.lit(run_at).alias("run_at"), "overall", "by_category")).alias("report"))


def write_benchmark(folder: str, report: DataFrame, judged: DataFrame) -> list[str]:
    """The report's one row as ``report``, and every judged case of every classifier as JSON lines in ``cases``.

    A case's row says what each classifier answered, whether it was right, and how long it took. The
    cases are written where they lie: no case passes the driver, and none is part of the summary.
    """
    report.write.mode("overwrite").text(f"{folder}/report")
    cases = judged.select("case_id", "category", "classifier", F.col("expected_label").alias("expected"), F.col("label").alias("answer"),
                          F.col("correct"), "matched", "error", "latency_ms")
    cases.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/cases")
    return ["report", "cases"]
