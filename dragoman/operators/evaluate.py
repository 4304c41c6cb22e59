"""Evaluation: benchmark accuracy and coverage, per-class reports, loss, latency, early stopping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from dragoman import dims
from dragoman.functions.arrays import smoothed_cross_entropy
from dragoman.functions.ranking import exact_percentiles
from dragoman.functions.text import percent


def judge(predictions: DataFrame, cases: DataFrame) -> DataFrame:
    """Long-form predictions with their case's category, expected label and correctness."""
    return predictions.join(cases.select("case_id", "category", "expected_label"), "case_id").withColumn(
        "correct", F.col("label") == F.col("expected_label"))


def counted(judged: DataFrame):
    """Which rows enter the accuracy: the regex counts matches, the main model answers, the LLM all."""
    return (F.when(F.col("classifier") == "regex", F.col("matched"))
            .when(F.col("classifier") == "main", F.col("error").isNull()).otherwise(F.lit(True)))


def timed(judged: DataFrame):
    """Which rows enter the mean latency."""
    return (F.when(F.col("classifier") == "regex", F.lit(True))
            .when(F.col("classifier") == "main", F.col("error").isNull() & (F.col("latency_ms") > 0))
            .otherwise(F.col("error").isNull()))


def benchmark(judged: DataFrame) -> DataFrame:
    """Overall and per category in one pass; ``category`` null is the overall row."""
    used, latency = counted(judged), timed(judged)
    return judged.groupingSets([["classifier", "category"], ["classifier"]], "classifier", "category").agg(
        F.count_if(used & F.col("correct")).alias("correct"),
        F.count_if(used).alias("counted"),
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(latency, F.col("latency_ms"))).alias("_latency"),
        F.count_if(latency).alias("_timed"),
    ).withColumns({
        "accuracy": percent(F.col("correct"), F.col("counted")),
        "coverage_pct": percent(F.col("counted"), F.col("total")),
        # unrounded: rounding here would print sub-microsecond latencies as zero
        "avg_latency_ms": F.coalesce(F.col("_latency") / F.when(F.col("_timed") > 0, F.col("_timed")), F.lit(0.0)),
    }).drop("_latency", "_timed")


def benchmark_overall(judged: DataFrame) -> DataFrame:
    return benchmark(judged).filter(F.col("category").isNull()).drop("category")


def benchmark_by_category(judged: DataFrame) -> DataFrame:
    return categories_of(benchmark(judged))


def categories_of(figures: DataFrame) -> DataFrame:
    """From ``benchmark`` rows one row per category; regex accuracy null when nothing matched, coverage as ``a/b``.

    ``b`` is the main model's answered rows, as published; ``size`` is the true size.
    """
    rows = figures.filter(F.col("category").isNotNull())

    def of(classifier, column):
        return F.max(F.when(F.col("classifier") == classifier, F.col(column)))

    return rows.groupBy("category").agg(
        of("main", "accuracy").alias("main_accuracy"),
        F.when(of("regex", "counted") > 0, of("regex", "accuracy")).alias("regex_accuracy"),
        F.concat_ws("/", of("regex", "counted").cast("string"), of("main", "counted").cast("string")).alias("regex_coverage"),
        of("llm", "accuracy").alias("llm_accuracy"),
        of("main", "total").alias("size"))


def summary_of(figures: DataFrame) -> DataFrame:
    """From ``benchmark`` rows the overall figures in one row."""
    rows = figures.filter(F.col("category").isNull())
    cells = [F.max(F.when(F.col("classifier") == c, F.col(m))).alias(f"{c}_{m}")
             for c in ("main", "regex", "llm") for m in ("correct", "counted", "total", "accuracy", "coverage_pct", "avg_latency_ms")]
    return rows.agg(*cells)


def summary_by_classifier(figures: DataFrame) -> DataFrame:
    """From ``benchmark`` rows one struct per classifier: right answers, rows that count, all rows, shares and mean latency."""
    s = summary_of(figures)
    cells = {c: F.struct(*[F.col(f"{c}_{m}").alias(n) for m, n in (
        ("correct", "correct"), ("counted", "counted"), ("total", "total"), ("accuracy", "accuracy"),
        ("coverage_pct", "coverage_pct"))], F.round(f"{c}_avg_latency_ms", 6).alias("avg_latency_ms")) for c in ("main", "regex", "llm")}
    return s.select(F.col("main_total").alias("test_cases"), *[cell.alias(c) for c, cell in cells.items()])


def speedup(judged: DataFrame, floor_ms: float = 0.1) -> DataFrame:
    s = summary_of(benchmark(judged))
    return s.select(F.round(F.col("llm_avg_latency_ms") / F.greatest("main_avg_latency_ms", F.lit(floor_ms)), 4).alias("speedup"))


def confusion(predictions: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Long-form confusion counts: the only aggregate over the prediction rows."""
    return predictions.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(predictions: DataFrame, truth: str, predicted: str, classes: list) -> DataFrame:
    """Wide confusion matrix for a known list of classes."""
    return confusion(predictions, truth, predicted).groupBy("truth").pivot("predicted", classes).agg(
        F.sum("n")).na.fill(0)


def classification_report(matrix: DataFrame) -> DataFrame:
    """Per class precision, recall, F1, support, with accuracy, macro and weighted means.

    ``matrix`` is the long confusion table, so everything here is a row per class pair.
    Classes are those that occur as truth or prediction; 0/0 counts as 0.
    """
    truth = matrix.groupBy(F.col("truth").alias("class")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)).alias("hits"))
    guessed = matrix.groupBy(F.col("predicted").alias("class")).agg(F.sum("n").alias("guesses"))
    per = truth.join(guessed, "class", "full_outer").na.fill(0, ["support", "hits", "guesses"])

    def ratio(a, b):
        return F.coalesce(a / F.when(b > 0, b), F.lit(0.0))

    scored = per.select(
        "class", "support", "hits", ratio(F.col("hits"), F.col("guesses")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
    ).withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    whole = Window.partitionBy(F.lit(0))  # a row per class
    weight = F.col("support") / F.sum("support").over(whole)
    return scored.select(
        "class", "support", "precision", "recall", "f1",
        (F.sum("hits").over(whole) / F.sum("support").over(whole)).alias("accuracy"),
        F.avg("f1").over(whole).alias("macro_f1"),
        F.sum(F.col("f1") * F.col("support")).over(whole).alias("_wf1"), F.sum("support").over(whole).alias("_s"),
    ).withColumn("weighted_f1", F.col("_wf1") / F.col("_s")).drop("_wf1", "_s")


def two_head_loss(rows: DataFrame, weight_a: float = dims.LOSS_WEIGHT_INTENT, weight_b: float = dims.LOSS_WEIGHT_RESOURCE,
                  smoothing: float = dims.LABEL_SMOOTHING) -> DataFrame:
    """Mean combined loss and the loss of each head, from logits ``la, lb`` and targets ``ya, yb``."""
    losses = rows.select(
        smoothed_cross_entropy(F.col("la"), F.col("ya"), smoothing).alias("a"),
        smoothed_cross_entropy(F.col("lb"), F.col("yb"), smoothing).alias("b"))
    return losses.agg(
        F.avg(F.lit(weight_a) * F.col("a") + F.lit(weight_b) * F.col("b")).alias("loss"),
        F.avg("a").alias("loss_a"), F.avg("b").alias("loss_b"), F.count(F.lit(1)).alias("rows"))


LATENCY_SHARES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}


def latency_percentiles(predictions: DataFrame, budget_ms: float = 5.0, approximate: bool = False) -> DataFrame:
    """p50, p95, p99 per classifier with linear interpolation, and whether p95 is in budget."""
    if approximate:
        found = predictions.groupBy("classifier").agg(
            F.percentile_approx("latency_ms", list(LATENCY_SHARES.values()), 10_000).alias("p"))
        found = found.select("classifier", *[F.get("p", F.lit(i)).alias(n) for i, n in enumerate(LATENCY_SHARES)])
    else:
        found = exact_percentiles(predictions, ["classifier"], "latency_ms", LATENCY_SHARES)
    return found.withColumn("within_budget", F.col("p95") < budget_ms)


def early_stopping(history: DataFrame, patience: int = dims.PATIENCE_MAIN, score: str = "val_f1") -> DataFrame:
    """Per run and epoch: best so far, epochs without improvement, stop epoch, best epoch.

    A run has as many rows as epochs, so a run per window partition is bounded.
    """
    run = Window.partitionBy("run").orderBy("epoch")
    before = run.rowsBetween(Window.unboundedPreceding, -1)
    streaks = history.withColumn(
        "is_best", F.col(score) > F.coalesce(F.max(score).over(before), F.lit(0.0))
    ).withColumn("_streak", F.sum(F.col("is_best").cast("int")).over(run))
    in_streak = Window.partitionBy("run", "_streak").orderBy("epoch")
    # before the first best every epoch counts; afterwards the best epoch itself does not
    waiting = streaks.withColumn("no_improve", F.row_number().over(in_streak) - F.when(F.col("_streak") > 0, 1).otherwise(0))
    whole = Window.partitionBy("run")
    stopped = waiting.withColumn("stop_epoch", F.min(F.when(F.col("no_improve") >= patience, F.col("epoch"))).over(whole))
    seen = stopped.filter(F.col("stop_epoch").isNull() | (F.col("epoch") <= F.col("stop_epoch")))
    return seen.withColumn("best_epoch", F.max(F.when(F.col("is_best"), F.col("epoch"))).over(whole)).drop("_streak")
