"""Queries over scoring, evaluation, usage, planning, tokens, language, models and streams."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession, functions as F

from dragoman import dims
from dragoman.functions import arrays
from dragoman.functions.plan import spread, through_table
from dragoman.operators import bpe, evaluate, language, models, planning, progress, refine, scoring, tokens, training
from dragoman.plans import views
from dragoman.plans.queries_refine import COUNTS, counts, filtered, loaded, verified, with_flush
from dragoman.plans.registry import query
from dragoman.plans.views_sql import bucket, case, lit, pick_language, with_views
from dragoman.session import ensure_checkpoint_dir, shared_folder
from dragoman.sources import sinks
from dragoman.streaming import jobs

# --- scoring ------------------------------------------------------------------------------------
def scored(spark: SparkSession, sf_dir: str):
    return scoring.softmax_argmax(views.logits(spark, sf_dir))


@query("p14_softmax_argmax", with_views(
    "SELECT row_id, intent_idx::INT AS intent_idx, resource_idx::INT AS resource_idx, round(list_max(pa), 4) AS confidence_intent, "
    "round(list_max(pb), 4) AS confidence_resource FROM decoded", "decoded"))
def p14(spark, sf_dir):
    return scored(spark, sf_dir).select("row_id", "intent_idx", "resource_idx", "confidence_intent", "confidence_resource")


@query("p15_decode_prediction", with_views(
    "SELECT row_id, d.class_id AS intent_class_id, d.label AS intent_class_label, d.tier, CASE WHEN d.label = 'adversarial_probe' THEN 'block' WHEN d.tier = '1' THEN 'drop' "
    "WHEN d.tier = '2' THEN 'static_template' WHEN d.tier = '3' THEN 'device_api' WHEN d.tier = '4' THEN 'cache_lookup' ELSE 'route_to_frontier' END AS routing_action, "
    "r.resource_class, CASE WHEN row_id % 2 = 0 THEN len(pa) END::INT AS n_probs, CASE WHEN row_id % 2 = 0 THEN round(pa[1], 4) END AS first_prob "
    "FROM decoded x JOIN dim_intent d ON d.class_idx = x.intent_idx JOIN dim_resource r ON r.resource_idx = x.resource_idx", "decoded"))
def p15(spark, sf_dir):
    named = scoring.decode_prediction(scored(spark, sf_dir), include_probs=F.col("row_id") % 2 == 0)
    return named.select("row_id", "intent_class_id", "intent_class_label", "tier", "routing_action", "resource_class",
                        F.array_size("probabilities_intent").alias("n_probs"),
                        F.get("probabilities_intent", F.lit(0)).alias("first_prob"))


@query("p16_batch_requests", with_views(
    "SELECT h.batch_id, status, n_texts, CASE WHEN status = 'ok' THEN n_texts ELSE 0 END AS results, CASE WHEN status = 'ok' THEN t END AS total_ms, "
    "CASE WHEN status = 'ok' THEN round(t / n_texts, 3) END AS avg_ms FROM (SELECT h.batch_id, count(i.msg_id) AS n_texts, round(sum(i.value), 3) AS t, "
    "CASE WHEN count(i.msg_id) = 0 THEN 'empty' WHEN count(i.msg_id) > 64 THEN 'too_many' ELSE 'ok' END AS status "
    "FROM batch_headers h LEFT JOIN batch_items i USING (batch_id) GROUP BY 1) h", "batch_headers"))
def p16(spark, sf_dir):
    status, accepted = scoring.accept_batches(views.batch_headers(spark, sf_dir), views.batch_items(spark, sf_dir))
    return scoring.batch_summary(status, accepted.withColumn("latency_ms", F.col("value")))


@query("t1_top1", with_views("SELECT row_id, intent_idx::INT AS class_idx FROM decoded", "decoded"))
def t1(spark, sf_dir):
    return views.logits(spark, sf_dir).select("row_id", arrays.argmax(F.col("la")).alias("class_idx"))


@query("t2_topk_probs", with_views(
    "SELECT row_id, place::INT AS place, class_idx::INT AS class_idx, round(p, 6) AS prob FROM (SELECT row_id, n - 1 AS class_idx, pa[n] AS p, "
    "row_number() OVER (PARTITION BY row_id ORDER BY pa[n] DESC, n) AS place FROM soft, unnest(range(1, 23)) AS u(n)) WHERE place <= 3", "soft"))
def t2(spark, sf_dir):
    return scoring.top_classes(scored(spark, sf_dir), 3).withColumn("prob", F.round("prob", 6))


def letter_model():
    """A stand-in for a user's model: logits are letter counts, loaded once per worker."""
    letters, vowels = "abcdefghijklmnopqrstuv", "aeiou"

    def predict(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        lower = texts.fillna("").str.lower()
        table = np.stack([lower.str.count(c).to_numpy() for c in letters], axis=1)
        return table, table[:, [letters.index(v) for v in vowels]]

    return predict


_LETTERS = ", ".join(f"(length(t) - length(replace(t, '{c}', '')))" for c in "abcdefghijklmnopqrstuv")
_VOWELS = ", ".join(f"(length(t) - length(replace(t, '{c}', '')))" for c in "aeiou")


@query("n6_score_udf", with_views(
    "SELECT msg_id, d.class_id AS intent_class_id, r.resource_class FROM (SELECT msg_id, list_position(a, list_max(a)) - 1 AS ia, list_position(b, list_max(b)) - 1 AS ib FROM ("
    f"SELECT msg_id, [{_LETTERS}] AS a, [{_VOWELS}] AS b FROM (SELECT msg_id, lower(text) AS t FROM utterances))) "
    "JOIN dim_intent d ON class_idx = ia JOIN dim_resource r ON resource_idx = ib", "utterances", "dim_intent", "dim_resource"))
def n6(spark, sf_dir):
    rows = scoring.score_udf(views.utterances(spark, sf_dir).select("msg_id", "text"), letter_model)
    return scoring.decode_prediction(scoring.softmax_argmax(rows)).select("msg_id", "intent_class_id", "resource_class")


# --- evaluation ----------------------------------------------------------------------------------
def judged(spark: SparkSession, sf_dir: str):
    return evaluate.judge(views.predictions(spark, sf_dir), views.cases(spark, sf_dir))


@query("j6_cases_predictions", with_views("SELECT case_id, classifier, category, label, expected_label, correct FROM judged", "judged"))
def j6(spark, sf_dir):
    return judged(spark, sf_dir).select("case_id", "classifier", "category", "label", "expected_label", "correct")


_USED = "CASE classifier WHEN 'regex' THEN matched WHEN 'main' THEN error IS NULL ELSE true END"
_TIMED = "CASE classifier WHEN 'regex' THEN true WHEN 'main' THEN error IS NULL AND latency_ms > 0 ELSE error IS NULL END"
_BENCH = (
    "SELECT *, round(correct::DOUBLE / greatest(counted, 1) * 100, 1) AS accuracy, round(counted::DOUBLE / greatest(total, 1) * 100, 1) AS coverage_pct FROM ("
    f"SELECT classifier, category, count_if(({_USED}) AND correct) AS correct, count_if({_USED}) AS counted, count(*) AS total, "
    f"coalesce(avg(CASE WHEN {_TIMED} THEN latency_ms END), 0) AS avg_latency_ms FROM judged GROUP BY GROUPING SETS ((classifier, category), (classifier)))")


@query("a6_benchmark_overall", with_views(
    f"SELECT classifier, correct, counted, total, accuracy, coverage_pct, round(avg_latency_ms, 6) AS avg_latency_ms FROM ({_BENCH}) WHERE category IS NULL", "judged"))
def a6(spark, sf_dir):
    return evaluate.benchmark_overall(judged(spark, sf_dir)).withColumn("avg_latency_ms", F.round("avg_latency_ms", 6))


_BY_CATEGORY = (
    "SELECT category, max(CASE WHEN classifier = 'main' THEN accuracy END) AS main_accuracy, max(CASE WHEN classifier = 'regex' AND counted > 0 THEN accuracy END) AS regex_accuracy, "
    "max(CASE WHEN classifier = 'regex' THEN counted END) || '/' || max(CASE WHEN classifier = 'main' THEN counted END) AS regex_coverage, "
    f"max(CASE WHEN classifier = 'llm' THEN accuracy END) AS llm_accuracy, max(CASE WHEN classifier = 'main' THEN total END) AS size FROM ({_BENCH}) WHERE category IS NOT NULL GROUP BY 1")


@query("a7_benchmark_by_category", with_views(_BY_CATEGORY, "judged"))
def a7(spark, sf_dir):
    return evaluate.benchmark_by_category(judged(spark, sf_dir))


@query("s7_benchmark_report", with_views(
    "SELECT to_json({'run_at': '2024-02-01T00:00:00Z', 'overall': (SELECT {'main_accuracy': max(accuracy) FILTER (classifier = 'main'), "
    "'regex_accuracy': max(accuracy) FILTER (classifier = 'regex'), 'regex_coverage_pct': max(coverage_pct) FILTER (classifier = 'regex'), "
    f"'llm_accuracy': max(accuracy) FILTER (classifier = 'llm')}} FROM ({_BENCH}) WHERE category IS NULL), "
    "'by_category': (SELECT list({'category': category, 'main_accuracy': main_accuracy, 'regex_accuracy': regex_accuracy, 'regex_coverage': regex_coverage, "
    f"'llm_accuracy': llm_accuracy, 'size': size}} ORDER BY category) FROM ({_BY_CATEGORY}))}})::VARCHAR AS report", "judged"))
def s7(spark, sf_dir):
    figures = through_table(evaluate.benchmark(judged(spark, sf_dir)), "benchmark")
    overall = evaluate.summary_of(figures).select("main_accuracy", "regex_accuracy", "regex_coverage_pct", "llm_accuracy")
    return sinks.benchmark_report(overall, evaluate.categories_of(figures), "2024-02-01T00:00:00Z")


@query("s7_benchmark_files", with_views(
    "SELECT 'case' AS kind, classifier, case_id, category, expected_label AS expected, label AS answer, correct, latency_ms, "
    "NULL::BIGINT AS n_correct, NULL::BIGINT AS n_counted, NULL::BIGINT AS n_total, NULL::DOUBLE AS accuracy, NULL::DOUBLE AS avg_latency_ms FROM judged UNION ALL "
    "SELECT 'overall', classifier, NULL, NULL, NULL, NULL, NULL, NULL, correct, counted, total, accuracy, round(avg_latency_ms, 6) "
    f"FROM ({_BENCH}) WHERE category IS NULL", "judged"))
def s7_files(spark, sf_dir):
    """The report and all cases, written and read back."""
    rows = through_table(judged(spark, sf_dir), "judged")
    figures = through_table(evaluate.benchmark(rows), "benchmark")
    folder, overall = shared_folder(spark, "report"), evaluate.summary_by_classifier(figures)
    sinks.write_benchmark(folder, sinks.benchmark_report(overall, evaluate.categories_of(figures), "2024-02-01T00:00:00Z"), rows)
    cases = spark.read.schema("classifier string, case_id long, category string, expected string, answer string, correct boolean, latency_ms double").json(f"{folder}/cases")
    report = spark.read.text(f"{folder}/report").select(F.from_json("value", f"overall struct<{', '.join(f'{c}: {_FIGURES}' for c in ('main', 'regex', 'llm'))}>").alias("r"))
    parts = F.array(*[F.struct(F.lit(c).alias("classifier"), F.col(f"r.overall.{c}").alias("f")) for c in ("main", "regex", "llm")])
    whole = report.select(F.explode(parts).alias("p")).select(
        F.lit("overall").alias("kind"), "p.classifier", F.col("p.f.correct").alias("n_correct"), F.col("p.f.counted").alias("n_counted"),
        F.col("p.f.total").alias("n_total"), "p.f.accuracy", "p.f.avg_latency_ms")
    return cases.withColumn("kind", F.lit("case")).unionByName(whole, allowMissingColumns=True)


_FIGURES = "struct<correct: bigint, counted: bigint, total: bigint, accuracy: double, avg_latency_ms: double>"


@query("a14_speedup", with_views(
    "SELECT round(max(avg_latency_ms) FILTER (classifier = 'llm') / greatest(max(avg_latency_ms) FILTER (classifier = 'main'), 0.1), 4) AS speedup "
    f"FROM ({_BENCH}) WHERE category IS NULL", "judged"))
def a14(spark, sf_dir):
    return evaluate.speedup(judged(spark, sf_dir))


_REPORT = (
    "per AS (SELECT class, count_if(side = 't') AS support, count_if(side = 't' AND hit) AS hits, count_if(side = 'p') AS guesses FROM ("
    "SELECT expected_label AS class, 't' AS side, correct AS hit FROM judged WHERE classifier = 'main' AND error IS NULL UNION ALL "
    "SELECT label, 'p', correct FROM judged WHERE classifier = 'main' AND error IS NULL) GROUP BY 1), "
    "pr AS (SELECT *, coalesce(hits / nullif(guesses, 0)::DOUBLE, 0) AS precision, coalesce(hits / nullif(support, 0)::DOUBLE, 0) AS recall FROM per), "
    "f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM pr) "
    "SELECT class, support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(sum(hits) OVER () / sum(support) OVER ()::DOUBLE, 6) AS accuracy, "
    "round(avg(f1) OVER (), 6) AS macro_f1, round(sum(f1 * support) OVER () / sum(support) OVER (), 6) AS weighted_f1 FROM f")


def main_answers(spark, sf_dir):
    return judged(spark, sf_dir).filter((F.col("classifier") == "main") & F.col("error").isNull())


@query("a8_classification_report", with_views("", "judged").rstrip() + ", " + _REPORT)
def a8(spark, sf_dir):
    report = evaluate.classification_report(evaluate.confusion(main_answers(spark, sf_dir), "expected_label", "label"))
    floats = ["precision", "recall", "f1", "accuracy", "macro_f1", "weighted_f1"]
    return report.withColumns({c: F.round(c, 6) for c in floats})


@query("a9_confusion_matrix", with_views(
    "SELECT ya AS truth, " + ", ".join(f"count_if(intent_idx = {i}) AS p{i}" for i in range(22)) + " FROM decoded GROUP BY 1", "decoded"))
def a9(spark, sf_dir):
    wide = evaluate.confusion_matrix(scored(spark, sf_dir), "ya", "intent_idx", list(range(22)))
    return wide.select("truth", *[F.col(f"`{i}`").alias(f"p{i}") for i in range(22)])


def _ce(logits: str, y: str) -> str:
    lse = f"(list_max({logits}) + ln(list_sum(list_transform({logits}, lambda x: exp(x - list_max({logits}))))))"
    return f"(-0.9::DOUBLE * ({logits}[{y} + 1] - {lse}) - 0.1::DOUBLE / len({logits}) * (list_sum({logits}) - len({logits}) * {lse}))"


@query("a10_two_head_loss", with_views(
    "SELECT round(avg(0.7::DOUBLE * a + 0.3::DOUBLE * b), 6) AS loss, round(avg(a), 6) AS loss_a, round(avg(b), 6) AS loss_b, count(*) AS rows "
    f"FROM (SELECT {_ce('la', 'ya')} AS a, {_ce('lb', 'yb')} AS b FROM logits)", "logits"))
def a10(spark, sf_dir):
    return evaluate.two_head_loss(views.logits(spark, sf_dir)).withColumns(
        {c: F.round(c, 6) for c in ("loss", "loss_a", "loss_b")})


@query("a11_latency_percentiles", with_views(
    "SELECT classifier, round(quantile_cont(latency_ms, 0.5), 6) AS p50, round(quantile_cont(latency_ms, 0.95), 6) AS p95, round(quantile_cont(latency_ms, 0.99), 6) AS p99, "
    "quantile_cont(latency_ms, 0.95) < 5 AS within_budget FROM predictions GROUP BY 1", "predictions"))
def a11(spark, sf_dir):
    found = evaluate.latency_percentiles(views.predictions(spark, sf_dir))
    return found.withColumns({c: F.round(c, 6) for c in ("p50", "p95", "p99")})


@query("w1_early_stopping", with_views("", "history").replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + (
    ", h AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY epoch) AS i FROM history), "
    "r AS (SELECT run, i, epoch, val_f1, val_f1 > 0 AS is_best, greatest(val_f1, 0) AS best, CASE WHEN val_f1 > 0 THEN 0 ELSE 1 END AS no_improve, "
    "CASE WHEN val_f1 > 0 THEN epoch END AS best_epoch, false AS halted FROM h WHERE i = 1 UNION ALL "
    "SELECT h.run, h.i, h.epoch, h.val_f1, h.val_f1 > r.best, greatest(r.best, h.val_f1), CASE WHEN h.val_f1 > r.best THEN 0 ELSE r.no_improve + 1 END, "
    "CASE WHEN h.val_f1 > r.best THEN h.epoch ELSE r.best_epoch END, r.no_improve >= 4 FROM r JOIN h ON h.run = r.run AND h.i = r.i + 1 WHERE r.no_improve < 4) "
    "SELECT run, epoch, round(val_f1, 6) AS val_f1, is_best, no_improve, max(CASE WHEN no_improve >= 4 THEN epoch END) OVER (PARTITION BY run) AS stop_epoch, "
    "max(best_epoch) OVER (PARTITION BY run) AS best_epoch FROM r"))
def w1(spark, sf_dir):
    return evaluate.early_stopping(views.history(spark, sf_dir)).withColumn("val_f1", F.round("val_f1", 6))


# --- usage ------------------------------------------------------------------------------------------
_USAGE = ("(SELECT g.day, g.provider, g.model, g.daily_limit, coalesce(calls, 0) AS calls, coalesce(failed, 0) AS failed FROM ("
          "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day, m.* FROM api_calls, call_models m) g LEFT JOIN ("
          "SELECT strftime(ts, '%Y-%m-%d') AS day, provider, model, count(*) AS calls, count_if(NOT ok) AS failed FROM api_calls GROUP BY ALL) u USING (day, provider, model))")
_STOP = "floor(coalesce(daily_limit, CASE provider WHEN 'groq' THEN 1000 WHEN 'gemini' THEN 20 END) * 0.95::DOUBLE)::INT"


@query("a4_daily_usage", with_views(f"SELECT day, provider, model, calls, failed FROM {_USAGE}", "api_calls", "call_models"))
def a4(spark, sf_dir):
    return progress.daily_usage(views.api_calls(spark, sf_dir), views.call_models(spark))


@query("a5_quota_status", with_views(
    "SELECT *, bool_and(exhausted) OVER (PARTITION BY day, provider) AS provider_stopped FROM (SELECT day, provider, model, calls, stop_at, coalesce(calls >= stop_at, false) AS exhausted "
    f"FROM (SELECT *, {_STOP} AS stop_at FROM {_USAGE}))", "api_calls", "call_models"))
def a5(spark, sf_dir):
    return progress.quota_status(views.api_calls(spark, sf_dir), views.call_models(spark))


@query("w6_usage_running", with_views(
    "SELECT call_id, provider, model, strftime(ts, '%Y-%m-%d') AS day, row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d'), model ORDER BY call_id) AS used FROM api_calls", "api_calls"))
def w6(spark, sf_dir):
    return progress.usage_running(views.api_calls(spark, sf_dir)).select(
        "call_id", "provider", "model", "day", "used")


@query("w6_first_exhaustion", with_views(
    "SELECT day, provider, model, call_id, used FROM (SELECT *, strftime(ts, '%Y-%m-%d') AS day, row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d'), model ORDER BY call_id) AS used "
    f"FROM api_calls JOIN call_models USING (provider, model)) WHERE used = {_STOP}", "api_calls", "call_models"))
def w6_first(spark, sf_dir):
    return progress.first_exhaustion(views.api_calls(spark, sf_dir), views.call_models(spark)).drop("ts")


_OWN = {p: [m for q, m, *_ in dims.MODELS if q == p] for p in dict.fromkeys(p for p, *_ in dims.MODELS)}
_TURN = "(row_number() OVER (PARTITION BY provider ORDER BY call_id) - 1)"


@query("w5_round_robin", with_views(
    "SELECT call_id, provider, CASE provider " + " ".join(
        f"WHEN {lit(p)} THEN [{', '.join(lit(m) for m in ms)}][({_TURN} % {len(ms)} + 1)::INT]" for p, ms in _OWN.items()) + " END AS assigned FROM api_calls", "api_calls"))
def w5(spark, sf_dir):
    return planning.round_robin(views.api_calls(spark, sf_dir), spark.createDataFrame(
        [(p, k, m) for p, ms in _OWN.items() for k, m in enumerate(ms)], "provider string, position int, model string")).select("call_id", "provider", "assigned")


# --- planning ---------------------------------------------------------------------------------------
_PLAN = (
    "SELECT class_id, label, tier, n AS request_no, least(20, target - existing - (n - 1) * 20) AS size, "
    + pick_language("class_id", bucket("class_id || ':' || n"), 0) + " AS language_iso, "
    + pick_language("class_id", bucket("class_id || ':' || n"), 1) + " AS resource_class "
    f"FROM {COUNTS}, unnest(range(1, (ceil((target - existing) / 20.0) + 1)::BIGINT)) AS u(n) WHERE existing < target")


@query("b1_plan_single", with_views(_PLAN, "filtered"))
def b1(spark, sf_dir):
    return planning.plan_single(counts(spark, sf_dir))


_POOL_SIZES = " UNION ALL ".join(
    f"SELECT {lit(pool)} AS pool, {dims.REQUEST_SIZES[pool]} AS request_size, [{', '.join(lit(t) for t in tiers)}] AS tiers, "
    f"{'NULL' if only is None else only}::INT[] AS only_ids, {never}::INT[] AS never_ids" for pool, tiers, only, never in dims.POOL_RULES)
_POOL_KEY = bucket("pool || ':' || class_id || ':' || n")


@query("b1_plan_pools", with_views(
    "SELECT pool, class_id, label, tier, n AS request_no, least(request_size, share - (n - 1) * request_size)::BIGINT AS size, "
    + pick_language("class_id", _POOL_KEY, 0) + " AS language_iso, " + pick_language("class_id", _POOL_KEY, 1) + " AS resource_class FROM ("
    "SELECT *, (ceil(remaining * upto / whole::DOUBLE) - ceil(remaining * (upto - request_size) / whole::DOUBLE))::BIGINT AS share FROM ("
    "SELECT pool, request_size, c.class_id, c.label, c.tier, target - existing AS remaining, sum(request_size) OVER (PARTITION BY c.class_id ORDER BY pool) AS upto, "
    f"sum(request_size) OVER (PARTITION BY c.class_id) AS whole FROM {COUNTS} c JOIN ({_POOL_SIZES}) ON list_contains(tiers, c.tier) "
    "AND (only_ids IS NULL OR list_contains(only_ids, c.class_id)) AND NOT list_contains(never_ids, c.class_id) WHERE existing < target)), "
    "unnest(range(1, ceil(share / request_size::DOUBLE)::BIGINT + 1)) AS u(n) WHERE share > 0", "filtered"))
def b1_pools(spark, sf_dir):
    pools = spark.createDataFrame(list(dims.REQUEST_SIZES.items()), "pool string, request_size int")
    return planning.plan_pools(through_table(counts(spark, sf_dir), "counts"), pools)


_ELIGIBLE = f"(SELECT class_id, label FROM {COUNTS} WHERE existing < target)"
_SAMPLED = (
    "SELECT request_id, class_id, label, place FROM (SELECT request_id, class_id, label, row_number() OVER (PARTITION BY request_id ORDER BY md5('42|' || request_id || '|' || class_id), class_id) AS place "
    f"FROM (SELECT DISTINCT conv_id AS request_id FROM conversations), {_ELIGIBLE}) WHERE place <= 6")


def eligible(spark, sf_dir):
    """Incomplete classes, as a small table: several steps of a plan look at it."""
    open_classes = counts(spark, sf_dir).filter(F.col("existing") < F.col("target")).select("class_id", "label")
    return through_table(open_classes, "eligible")


def sampled(spark, sf_dir, open_classes):
    requests = spread(views.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("request_id")).distinct(), "request_id")
    labels = dims.dim_intent(spark).select("class_id", "label")
    return planning.sample_k_classes(requests, open_classes).join(F.broadcast(labels), "class_id")


def allocated(spark, sf_dir):
    open_classes = eligible(spark, sf_dir)
    n = F.least(F.lit(dims.MIXED_CLASSES), open_classes.agg(F.count(F.lit(1))).scalar())
    return planning.allocate_mixed(sampled(spark, sf_dir, open_classes), n_classes=n)


_ALLOCATED = (
    f"SELECT *, greatest(1, 80 // k) + CASE WHEN place <= 80 - greatest(1, 80 // k) * k THEN 1 ELSE 0 END AS quantity FROM (SELECT *, least(6, (SELECT count(*) FROM {_ELIGIBLE})) AS k FROM ({_SAMPLED}))")
_SLOTS = (
    "SELECT request_id, place, class_id, label, n AS slot, " + pick_language("class_id", bucket("request_id || ':' || class_id || ':' || n"), 0) + " AS language_iso, "
    + pick_language("class_id", bucket("request_id || ':' || class_id || ':' || n"), 1) + f" AS resource_class FROM ({_ALLOCATED}), unnest(range(1, quantity + 1)) AS u(n)")


@query("t4_sample_k_classes", with_views(f"SELECT request_id, place::INT AS place, class_id FROM ({_SAMPLED})", "filtered"))
def t4(spark, sf_dir):
    return sampled(spark, sf_dir, eligible(spark, sf_dir)).select("request_id", "place", "class_id")


@query("b2_allocate_mixed", with_views(
    f"SELECT request_id, place::INT AS place, class_id, quantity::BIGINT AS quantity FROM ({_ALLOCATED})", "filtered"))
def b2(spark, sf_dir):
    return allocated(spark, sf_dir).select("request_id", "place", "class_id", "quantity")


@query("b3_plan_slots", with_views(
    f"SELECT request_id, place::INT AS place, class_id, label, slot, language_iso, resource_class FROM ({_SLOTS})", "filtered"))
def b3(spark, sf_dir):
    return planning.plan_slots(allocated(spark, sf_dir))


@query("b4_rate_plan", 
    "SELECT model, request_no, round((rk - 1) * gap, 3) AS send_at_s FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY request_no) AS rk FROM ("
    "SELECT event_id AS request_no, m.model, m.gap FROM events JOIN (SELECT * FROM (VALUES "
    + ", ".join(f"({i}, {lit(m[1])}, {m[4]!r}::DOUBLE)" for i, m in enumerate(dims.MODELS))
    + ") AS v(n, model, gap)) m ON n = event_id % 15)) WHERE (rk - 1) * gap < 600")
def b4(spark, sf_dir):
    names = F.array(*[F.lit(m[1]) for m in dims.MODELS])
    requests = views.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_no"), F.get(names, (F.col("event_id") % 15).cast("int")).alias("model"))
    return planning.rate_plan(requests, dims.dim_model(spark), budget_s=600).select(
        "model", "request_no", "send_at_s")


def _sql_template(template: str, values: dict[str, str]) -> str:
    import string
    parts = []
    for text, name, _, _ in string.Formatter().parse(template):
        if text:
            parts.append(lit(text))
        if name:
            parts.append(f"({values[name]})")
    return " || ".join(parts)


_NAMES = {iso: name for iso, _, _, name in dims.LANGUAGES}
_LANG_LINE = "CASE language_iso " + " ".join(
    f"WHEN {lit(iso)} THEN " + lit("LANGUAGE: English. Natural, varied English." if iso == "en" else (
        f"LANGUAGE: {name} ({iso}). Write authentic {name} as a native speaker would type it in a real app — natural vocabulary, not formal translation."
        if rc == "lr_emerging" else
        f"LANGUAGE: {name} ({iso}). Write in natural {name} as a native speaker would type — not translated English, genuine {name} phrasing."))
    for iso, rc, _, name in dims.LANGUAGES) + " END"
_SHOWN = "CASE WHEN language_iso = 'en' THEN " + case("class_id - 1", [
    lit("\n".join(f"  {e}" for e in dims.PROMPTS[c][2][:3])) for c in sorted(dims.PROMPTS)]) + " ELSE " + case("class_id - 1", [
        lit("\n".join(f"  {e}" for e in dims.PROMPTS[c][2][:2]) + "\n  (but write in ") for c in sorted(dims.PROMPTS)]) + " || language_iso || ')' END"
_DEFINITION = case("class_id - 1", [lit(dims.PROMPTS[c][0]) for c in sorted(dims.PROMPTS)])


@query("p17_render_prompts", with_views(
    "SELECT class_id, request_no, size, language_iso, " + _sql_template(planning.SINGLE_PROMPT, {
        "size": "size", "class_id": "class_id", "label": "label", "tier": "tier", "definition": _DEFINITION,
        "hint": case("class_id - 1", [lit(dims.PROMPTS[c][1]) for c in sorted(dims.PROMPTS)]),
        "examples": _SHOWN, "language": _LANG_LINE, "iso": "language_iso", "resource": "resource_class"})
    + f" AS prompt FROM ({_PLAN})", "filtered"))
def p17(spark, sf_dir):
    return planning.render_single(planning.plan_single(counts(spark, sf_dir))).select(
        "class_id", "request_no", "size", "language_iso", "prompt")


_NOTE = "CASE language_iso " + " ".join(
    f"WHEN {lit(iso)} THEN " + lit("Natural English" if iso == "en" else f"{name} — authentic, natural") for iso, _, _, name in dims.LANGUAGES) + " END"


@query("p17_render_mixed_prompts", with_views("", "filtered").rstrip() + (
    f", slots AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY place, slot) AS i, count(*) OVER (PARTITION BY request_id) AS total FROM ({_SLOTS})), "
    "lines AS (SELECT request_id, string_agg('  Example ' || i || ': class_id=' || class_id || ', label=\"' || label || '\", language_iso=\"' || language_iso || '\", resource_class=\"' || resource_class || '\" — ' || "
    f"{_NOTE}, chr(10) ORDER BY i) FILTER (i <= 30) || CASE WHEN max(total) > 30 THEN chr(10) || '  ... (continue same pattern for remaining ' || (max(total) - 30) || ' examples)' ELSE '' END AS plan_block FROM slots GROUP BY 1), "
    f"cls AS (SELECT request_id, place, '  - Class ' || class_id || ' (' || label || '): ' || count(*) || ' examples in languages: ' || string_agg(DISTINCT language_iso, ', ' ORDER BY language_iso) AS block, "
    f"'  Class ' || class_id || ' (' || label || '): ' || {_DEFINITION} AS meaning FROM slots GROUP BY request_id, place, class_id, label), "
    "blocks AS (SELECT request_id, count(*) AS n_classes, string_agg(block, chr(10) ORDER BY place) AS class_block, string_agg(meaning, chr(10) ORDER BY place) AS definitions FROM cls GROUP BY 1) "
    "SELECT request_id, " + _sql_template(planning.MIXED_PROMPT, {
        "total": "80", "n_classes": "n_classes", "class_block": "class_block", "plan_block": "plan_block", "definitions": "definitions"})
    + " AS prompt FROM blocks JOIN lines USING (request_id)"))
def p17_mixed(spark, sf_dir):
    return planning.render_mixed(planning.plan_slots(allocated(spark, sf_dir)))


# --- tokens ------------------------------------------------------------------------------------------
_WORDS = "SELECT w AS word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[^ \\t\\n\\r\\x0b\\x0c]+')) AS w FROM documents) GROUP BY 1"


@query("a15_word_counts", f"SELECT * FROM ({_WORDS}) WHERE n >= 2")
def a15(spark, sf_dir):
    return tokens.word_counts(views.documents(spark, sf_dir))


@query("n1_pair_counts",
       f"SELECT left_, right_, sum(n)::BIGINT AS freq FROM (SELECT n, substr(word, i::INT, 1) AS left_, substr(word, i::INT + 1, 1) AS right_ FROM ({_WORDS}), "
       "unnest(range(1, length(word))) AS u(i)) GROUP BY 1, 2")
def n1_round(spark, sf_dir):
    words = tokens.word_counts(views.documents(spark, sf_dir), min_count=1).select(F.split("word", "").alias("symbols"), "n")
    return tokens.pair_counts(words).select(F.col("left").alias("left_"), F.col("right").alias("right_"), "freq")


@query("n1_bpe_train")
def n1(spark, sf_dir):
    return bpe.bpe_train(views.documents(spark, sf_dir))[1]


@query("n2_bpe_encode")
def n2(spark, sf_dir):
    merges, vocabulary = bpe.bpe_train(views.documents(spark, sf_dir))
    return bpe.bpe_encode(views.documents(spark, sf_dir), merges, bpe.vocabulary_map(vocabulary)).select(
        "doc_id", F.size("ids").alias("n_ids"), F.md5(F.array_join("ids", ",")).alias("ids_md5"))


@query("n2_bpe_round_trip", "SELECT doc_id, md5(CASE WHEN text = '' OR starts_with(text, ' ') THEN text ELSE ' ' || text END) AS decoded_md5 FROM documents")
def n2_round_trip(spark, sf_dir):
    merges, vocabulary = bpe.bpe_train(views.documents(spark, sf_dir))
    known = bpe.vocabulary_map(vocabulary)
    encoded = bpe.bpe_encode(views.documents(spark, sf_dir), merges, known)
    return encoded.select("doc_id", F.md5(bpe.bpe_decode(F.col("ids"), known)).alias("decoded_md5"))


@query("n3_fixed_length",
       f"WITH v AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) + 4 AS id FROM (SELECT * FROM ({_WORDS}) WHERE n >= 2) ORDER BY n DESC, word LIMIT 31995), "
       "w AS (SELECT doc_id, i, ws[i] AS word FROM (SELECT doc_id, list_slice(regexp_extract_all(text, '[^ \\t\\n\\r\\x0b\\x0c]+'), 1, 126) AS ws FROM documents), unnest(range(1, len(ws) + 1)) AS u(i)), "
       "e AS (SELECT doc_id, list(coalesce(id, 1)::INT ORDER BY i) AS ids FROM w LEFT JOIN v USING (word) GROUP BY 1) "
       "SELECT doc_id, array_to_string([2] || coalesce(ids, []) || [3] || list_transform(range(126 - coalesce(len(ids), 0)), lambda x: 0), ',') AS input_ids, (coalesce(len(ids), 0) + 2)::INT AS used "
       "FROM documents LEFT JOIN e USING (doc_id)")
def n3(spark, sf_dir):
    vocabulary = tokens.word_vocabulary(tokens.word_counts(views.documents(spark, sf_dir)))
    encoded = tokens.encode_words(views.documents(spark, sf_dir), vocabulary, "doc_id")
    return encoded.select("doc_id", F.array_join("input_ids", ",").alias("input_ids"),
                          F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("used"))


# --- language ------------------------------------------------------------------------------------------
_BIGRAMS = ("SELECT lang, side, doc_id, unnest(list_transform(range(1, len(cp)), lambda i: ((cp[i] * 31 + cp[i + 1]) % 4096)::INT)) AS bucket "
            "FROM (SELECT lang, side, doc_id, list_transform(string_split({t}, ''), lambda c: unicode(c)) AS cp FROM lang_docs)")


def profile(spark, sf_dir):
    train = views.lang_docs(spark, sf_dir).filter(F.col("side") == "train")
    return language.language_profile(language.bigram_counts(train))


@query("n7_language_counts", with_views(
    "SELECT lang, bucket, count(*) AS n FROM (" + _BIGRAMS.format(t="lower(text)") + ") GROUP BY ALL", "lang_docs"))
def n7_counts(spark, sf_dir):
    return language.bigram_counts(views.documents(spark, sf_dir))


@query("n7_detect_language", with_views("", "lang_docs", "ws").rstrip() + (
    ", g AS MATERIALIZED (" + _BIGRAMS.format(t="lower(trim(text, (SELECT s FROM ws)))") + "), "
    "c AS (SELECT lang, bucket, count(*) AS n FROM (" + _BIGRAMS.format(t="lower(text)") + ") WHERE side = 'train' GROUP BY ALL), "
    "t AS (SELECT lang, sum(n) AS total FROM c GROUP BY 1), "
    "p AS (SELECT t.lang, b.bucket, ln((coalesce(n, 0) + 1)::DOUBLE / (total + 4096)) AS lp FROM t CROSS JOIN (SELECT unnest(range(4096))::INT AS bucket) b LEFT JOIN c ON c.lang = t.lang AND c.bucket = b.bucket), "
    "s AS (SELECT doc_id, p.lang, avg(lp) AS score FROM g JOIN p ON p.bucket = g.bucket GROUP BY ALL), "
    "w AS (SELECT *, exp((score - max(score) OVER (PARTITION BY doc_id)) * 20) AS w FROM s), "
    "q AS (SELECT doc_id, lang, w / sum(w) OVER (PARTITION BY doc_id) AS share, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS place FROM w), "
    "d AS (SELECT doc_id, max(lang) FILTER (place = 1) AS lang1, max(share) FILTER (place = 1) AS s1, coalesce(max(share) FILTER (place = 2), 0) AS s2 FROM q GROUP BY 1) "
    "SELECT l.doc_id, l.lang, l.side, CASE WHEN length(trim(text, (SELECT s FROM ws))) < 3 OR s1 IS NULL THEN 'en' WHEN s1 - s2 >= 0.1 THEN lang1 ELSE 'en' END AS language_iso, "
    "CASE WHEN length(trim(text, (SELECT s FROM ws))) < 3 OR s1 IS NULL THEN 0.0 WHEN s1 - s2 >= 0.1 THEN round(s1, 4) ELSE 0.0 END AS language_confidence "
    "FROM lang_docs l LEFT JOIN d USING (doc_id)"))
def n7(spark, sf_dir):
    return language.detect_language(views.lang_docs(spark, sf_dir), profile(spark, sf_dir)).select(
        "doc_id", "lang", "side", "language_iso", "language_confidence")


@query("n8_iso_to_resource", with_views(
    "SELECT coalesce(resource_class, 'hr_global') AS resource_class, count(*) AS n FROM examples LEFT JOIN dim_language ON iso = language_iso GROUP BY 1", "examples", "dim_language"))
def n8(spark, sf_dir):
    return language.iso_to_resource(loaded(spark, sf_dir).select("language_iso")).groupBy("resource_class").agg(
        F.count(F.lit(1)).alias("n"))


# --- models --------------------------------------------------------------------------------------------
def _fit(spark, sf_dir, **named):
    from dragoman.operators.split import stratified_split
    rows = through_table(filtered(spark, sf_dir), "filtered")
    parts = stratified_split(rows, "example_id", "class_id")
    train = parts.filter(F.col("split") == "train")
    return models.train_two_head(train, **named), parts


@query("n4_train_two_head")
def n4(spark, sf_dir):
    model, _ = _fit(spark, sf_dir, accuracy=True)
    rows = [(head, int(m.numClasses), int(m.numFeatures), accuracy)
            for head, m, accuracy in zip(("intent", "resource"), (model.intent, model.resource), model.accuracy)]
    return spark.createDataFrame(rows, "head string, classes int, features int, train_accuracy double")


@query("n4_early_stopped_training")
def n4_early(spark, sf_dir):
    """What each epoch gave, and where the rule of ``w1_early_stopping`` stops."""
    from dragoman.operators.split import stratified_split
    parts = through_table(stratified_split(through_table(filtered(spark, sf_dir), "filtered"), "example_id", "class_id"), "split")
    model = training.train_early_stopped(parts.filter("split = 'train'"), parts.filter("split = 'val'"))
    return evaluate.early_stopping(spark.createDataFrame(model.history))


@query("n5_score_two_head")
def n5(spark, sf_dir):
    model, _ = _fit(spark, sf_dir)
    messages = views.utterances(spark, sf_dir).select("msg_id", "text")
    return scoring.decode_prediction(scoring.softmax_argmax(models.score_two_head(model, messages))).select(
        "msg_id", "intent_class_id", "intent_class_label", "tier", "routing_action", "resource_class",
        "confidence_intent", "confidence_resource")


@query("n9_evaluate_split")
def n9(spark, sf_dir):
    model, parts = _fit(spark, sf_dir)
    return models.evaluate_split(model, parts.filter(F.col("split") == "test"))


# --- streams -------------------------------------------------------------------------------------------
def event_stream(spark, sf_dir):
    return jobs.file_stream(spark, sf_dir, views.table(spark, sf_dir, "events").schema, "events*.parquet")


def late_events(spark, sf_dir):
    """The events in files by part of the month, the latest days first, a file for each micro-batch."""
    folder, events = shared_folder(spark, "late-events"), views.table(spark, sf_dir, "events")
    for low, high in ((21, 31), (11, 20), (1, 10)):
        events.filter(F.dayofmonth("ts").between(low, high)).write.mode("append").parquet(folder)
    return jobs.file_stream(spark, folder, events.schema, max_files=1)


@query("x1_classify_stream", with_views(
    "SELECT msg_id, g.gate_rule, CASE WHEN gate_rule IS NOT NULL THEN 'noise_gibberish' ELSE label END AS label, CASE WHEN gate_rule IS NOT NULL THEN '1' ELSE tier END AS tier, "
    "CASE WHEN gate_rule IS NOT NULL THEN 'drop' ELSE action END AS action FROM routed JOIN gate g USING (msg_id)", "routed", "gate"))
def x1(spark, sf_dir):
    messages = views.utterances(spark, sf_dir, event_stream(spark, sf_dir)).select("msg_id", "text")
    return jobs.run_to_table(jobs.classify_stream(messages), "classify").select(
        "msg_id", "gate_rule", "label", "tier", "action")


@query("x2_refine_stream", with_views(
    "SELECT provider || ':' || model AS generated_by, intent_class_label, count(*) AS n FROM refined GROUP BY ALL", "refined"))
def x2(spark, sf_dir):
    base = shared_folder(spark, "refine")
    raw = views.raw_responses(spark, sf_dir)
    raw.write.parquet(f"{base}/in")
    stream = jobs.file_stream(spark, f"{base}/in", raw.schema, max_files=4)
    jobs.refine_stream(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    written = spark.read.option("recursiveFileLookup", "true").schema(
        "generated_by string, intent_class_label string").json(f"{base}/out")
    return written.groupBy("generated_by", "intent_class_label").agg(F.count(F.lit(1)).alias("n"))


@query("x2_skip_complete_stream", with_views(
    "SELECT response_id, item_no FROM verified WHERE status = 'valid' AND NOT (expected_class_id IS NULL AND class_id % 3 = 0)", "verified"))
def x2_skip(spark, sf_dir):
    """Every third class is complete from the start, the others never are: equals ``j3_skip_complete`` over batch."""
    base = shared_folder(spark, "refine")
    raw = views.raw_responses(spark, sf_dir)
    raw.write.parquet(f"{base}/in")
    held = dims.dim_intent(spark).select("class_id", F.lit(8000).cast("bigint").alias("existing"),
                                         F.when(F.col("class_id") % 3 == 0, 8000).otherwise(1 << 60).alias("target"))
    stream = jobs.file_stream(spark, f"{base}/in", raw.schema, max_files=4)
    jobs.refine_stream(stream, f"{base}/out", f"{base}/checkpoint", held).awaitTermination()
    return spark.read.option("recursiveFileLookup", "true").schema("response_id bigint, item_no int").json(f"{base}/out")


@query("x3_quota_stream", with_views(
    "SELECT intent_class_id, row_id FROM (SELECT (msg_id % 22 + 1)::INT AS intent_class_id, msg_id AS row_id, row_number() OVER (PARTITION BY msg_id % 22 ORDER BY msg_id) AS place FROM utterances) "
    "WHERE place <= 300", "utterances"))
def x3(spark, sf_dir):
    """The latest rows arrive first, so most of those accepted at first are replaced."""
    rows = late_events(spark, sf_dir).select((F.col("event_id") % 22 + 1).cast("int").alias("intent_class_id"), F.col("event_id").alias("row_id"))
    return jobs.accepted_rows(jobs.run_to_table(jobs.quota_stream(rows, 300), "quota"))


@query("x4_usage_stream", with_views(
    "SELECT strftime(ts, '%Y-%m-%d') AS day, provider, model, count(*) AS calls, count_if(NOT ok) AS failed FROM api_calls GROUP BY ALL", "api_calls"))
def x4(spark, sf_dir):
    calls = views.api_calls(spark, sf_dir, late_events(spark, sf_dir))
    return jobs.run_latest(jobs.usage_stream(calls), "usage", ["day", "provider", "model"])


def _latency_sql(days: int) -> str:
    """Windows of some days, one starting each day; p95 is the middle of the sketch bucket of the value ranked ceil(0.95 n)."""
    ratio = repr(jobs.SKETCH_RATIO)
    return with_views(
        f"SELECT strftime(start, '%Y-%m-%d %H:%M') AS window_start, classifier, count(*) AS rows, round(avg(value), 6) AS avg_ms, "
        f"round(coalesce(pow({ratio}::DOUBLE, ceil(ln(min(CASE WHEN place >= ceil(n * 0.95::DOUBLE) AND value > 0 THEN value END)) / ln({ratio}::DOUBLE))) * (2 / (1 + {ratio}::DOUBLE)), 0.0), 6) AS p95_ms, "
        "count_if(matched) AS covered FROM ("
        "SELECT *, row_number() OVER (PARTITION BY start, classifier ORDER BY value) AS place, count(*) OVER (PARTITION BY start, classifier) AS n FROM ("
        f"SELECT date_trunc('day', ts)::TIMESTAMP - to_days(off::INT) AS start, CASE WHEN matched THEN 'covered' ELSE 'open' END AS classifier, value, matched "
        f"FROM cascade, unnest(range({days})) AS u(off))) GROUP BY ALL", "cascade")


def _latency(spark, sf_dir, days):
    from dragoman.operators.cascade import regex_classify
    rows = regex_classify(views.utterances(spark, sf_dir, late_events(spark, sf_dir))).select(
        "ts", F.when(F.col("matched"), "covered").otherwise("open").alias("classifier"), "matched",
        F.col("value").alias("latency_ms"))
    panes = jobs.run_latest(jobs.latency_panes(rows), "latency", jobs.PANE_KEYS)
    return jobs.latency_windows(panes, 86_400, days).withColumns({c: F.round(c, 6) for c in ("avg_ms", "p95_ms")})


@query("x5_latency_stream", _latency_sql(1))
def x5(spark, sf_dir):
    return _latency(spark, sf_dir, 1)


@query("x5_latency_sliding", _latency_sql(3))
def x5_sliding(spark, sf_dir):
    return _latency(spark, sf_dir, 3)


@query("x6_checkpoint_stream", with_flush(
    "SELECT shard::INT AS shard, response_id AS seq, valid AS rows, flush_no FROM r", 50, "response_id % 4"))
def x6(spark, sf_dir):
    base = shared_folder(spark, "arrivals")
    rows = refine.discards_per_answer(verified(spark, sf_dir)).select(
        (F.col("response_id") % 4).cast("int").alias("shard"), F.col("response_id").alias("seq"), F.col("valid").alias("rows"))
    rows.write.parquet(f"{base}/in")
    stream = jobs.file_stream(spark, f"{base}/in", rows.schema)
    return jobs.run_to_table(jobs.checkpoint_stream(stream, 50), "flushes")
