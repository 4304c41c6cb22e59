import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dragoman import dims
from dragoman.functions import arrays
from dragoman.operators import evaluate, planning, progress, routing, scoring
from dragoman.plans.queries_analysis import letter_model


def test_softmax_argmax_and_topk(spark):
    rng = np.random.default_rng(0)
    table = rng.normal(size=(50, 22)) * 30
    table[0] = 1.0  # all tied
    df = spark.createDataFrame([(i, row.tolist(), row[:5].tolist()) for i, row in enumerate(table)], "row_id int, la array<double>, lb array<double>")
    for r in scoring.softmax_argmax(df).collect():
        e = np.exp(table[r["row_id"]] - table[r["row_id"]].max())
        assert np.allclose(r["probs_intent"], e / e.sum()) and math.isclose(sum(r["probs_intent"]), 1.0)
        assert r["intent_idx"] == int(np.argmax(table[r["row_id"]]))
    top = scoring.top_classes(scoring.softmax_argmax(df), 3).filter("row_id = 0").orderBy("place").collect()
    assert [r["class_idx"] for r in top] == [0, 1, 2]


def test_probabilities_only_on_request(spark):
    df = spark.createDataFrame([(1, [0.0] * 22, [0.0] * 5), (2, [0.0] * 22, [0.0] * 5)], "row_id int, la array<double>, lb array<double>")
    rows = {r["row_id"]: r for r in scoring.decode_prediction(scoring.softmax_argmax(df), F.col("row_id") == 1).collect()}
    assert len(rows[1]["probabilities_intent"]) == 22 and rows[2]["probabilities_intent"] is None
    assert rows[1]["intent_class_label"] == "noise_gibberish" and rows[1]["routing_action"] == "drop"


def test_batches_of_zero_and_sixty_five_are_refused(spark):
    headers = spark.createDataFrame([(b,) for b in (0, 1, 64, 65, 500)], "batch_id int")
    items = spark.createDataFrame([(b, i, 2.0) for b in (1, 64, 65, 500) for i in range(b)], "batch_id int, item_no int, latency_ms double")
    status, accepted = scoring.accept_batches(headers, items)
    rows = {r["batch_id"]: r for r in scoring.batch_summary(status, accepted).collect()}
    assert {b: r["status"] for b, r in rows.items()} == {0: "empty", 1: "ok", 64: "ok", 65: "too_many", 500: "too_many"}
    assert rows[64]["results"] == 64 and rows[64]["avg_ms"] == 2.0 and rows[500]["results"] == 0


def test_user_model_is_scored_in_batches(spark):
    df = spark.createDataFrame([(1, "aaab"), (2, "bbbb"), (3, None)], "row_id int, text string")
    rows = {r["row_id"]: r["intent_idx"] for r in scoring.softmax_argmax(scoring.score_udf(df, letter_model)).collect()}
    assert rows == {1: 0, 2: 1, 3: 0}


def test_routes_and_their_defaults(spark):
    df = spark.createDataFrame([("1", "noise_gibberish"), ("1", "adversarial_probe"), ("1", "other"), ("4", "x"), ("?", "unknown"), ("9", "x")], "tier string, label string")
    got = [(r["tier"], r["label"], r["action"]) for r in routing.route(df).collect()]
    assert sorted(a for _, _, a in got) == sorted(["drop", "block", "drop", "cache_lookup", "route_to_frontier", "route_to_frontier"])


def test_dispatch_picks_reply_cache_or_model(spark):
    df = spark.createDataFrame([
        (1, "a", "drop", "noise_gibberish", "1", "hr_global"), (2, "b", "block", "adversarial_probe", "1", "hr_global"),
        (3, "c", "static_template", "odd", "2", "hr_global"), (4, "known", "cache_lookup", "factoid_static", "4", "hr_global"),
        (5, "new", "cache_lookup", "factoid_static", "4", "hr_global"), (6, "f", "route_to_frontier", "code_task", "5A", "hr_global"),
        (7, "g", "route_to_frontier", "debate_opinion", "5B", "hr_global"), (8, "h", "route_to_frontier", "code_task", "5A", "lr_emerging")],
        "msg_id int, text string, action string, label string, tier string, resource_class string")
    cache = spark.createDataFrame([("known", "42")], "text string, answer string")
    rows = {r["msg_id"]: r for r in routing.dispatch(df, cache, hot_rows=1).collect()}
    m = dims.FRONTIER_MODELS
    assert rows[1]["reason"] == "noise" and rows[2]["response"] == dims.BLOCK_REPLY and rows[3]["response"] == "Hi there!"
    assert (rows[4]["response"], rows[4]["source"], rows[5]["handler"]) == ("42", "cache", "micro_llm")
    assert [rows[i]["handler"] for i in (6, 7, 8)] == [m["structured"], m["reasoning"], m["multilingual"]]


def test_report_on_a_known_confusion(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")] * 2 + [("b", "d")]
    df = spark.createDataFrame(pairs, "t string, p string")
    rows = {r["class"]: r for r in evaluate.classification_report(evaluate.confusion(df, "t", "p")).collect()}
    assert set(rows) == {"a", "b", "c", "d"}
    assert rows["a"]["precision"] == pytest.approx(3 / 5) and rows["a"]["recall"] == pytest.approx(3 / 4)
    assert rows["c"]["f1"] == 0 and rows["d"]["support"] == 0 and rows["a"]["accuracy"] == pytest.approx(5 / 9)
    f1 = {"a": 2 * 0.6 * 0.75 / 1.35, "b": 2 / 3, "c": 0, "d": 0}
    assert rows["a"]["macro_f1"] == pytest.approx(sum(f1.values()) / 4)
    assert rows["a"]["weighted_f1"] == pytest.approx((4 * f1["a"] + 3 * f1["b"]) / 9)


def test_loss_matches_numpy(spark):
    rng = np.random.default_rng(1)
    la, lb = rng.normal(size=(20, 22)) * 50, rng.normal(size=(20, 5))
    df = spark.createDataFrame([(a.tolist(), b.tolist(), i % 22, i % 5) for i, (a, b) in enumerate(zip(la, lb))], "la array<double>, lb array<double>, ya int, yb int")

    def ce(x, y):
        lp = x - x.max() - np.log(np.exp(x - x.max()).sum())
        return -0.9 * lp[y] - 0.1 / len(x) * lp.sum()

    want = np.mean([0.7 * ce(la[i], i % 22) + 0.3 * ce(lb[i], i % 5) for i in range(20)])
    assert evaluate.two_head_loss(df).first()["loss"] == pytest.approx(want)


@pytest.mark.parametrize("scores, best, stop", [
    ([0.5, 0.6, 0.6, 0.6, 0.6, 0.6, 0.9], 2, 6), ([0.1, 0.2, 0.3], 3, None), ([0.0, 0.0, 0.0, 0.0, 0.5], None, 4)])
def test_early_stopping(spark, scores, best, stop):
    df = spark.createDataFrame([("r", i, s) for i, s in enumerate(scores, 1)], "run string, epoch int, val_f1 double")
    rows = evaluate.early_stopping(df).orderBy("epoch").collect()
    assert rows[0]["best_epoch"] == best and rows[0]["stop_epoch"] == stop
    assert len(rows) == (stop or len(scores))


def test_fixed_length_cuts_and_pads(spark):
    df = spark.createDataFrame([(list(range(10, 14)),), (list(range(10, 40)),), ([],)], "ids array<int>")
    padded, mask = arrays.fixed_length(F.col("ids"), 8, 2, 3, 0)
    rows = df.select(padded.alias("p"), mask.alias("m")).collect()
    assert rows[0]["p"] == [2, 10, 11, 12, 13, 3, 0, 0] and rows[0]["m"] == [1] * 6 + [0] * 2
    assert rows[1]["p"] == [2, 10, 11, 12, 13, 14, 15, 3] and rows[2]["p"] == [2, 3] + [0] * 6


def test_plan_closes_each_deficit_exactly(spark):
    counts = spark.createDataFrame([(c, label, tier, (c - 1) * 20, 100 if c < 22 else 0) for c, label, tier in dims.INTENTS],
                                   "class_id int, label string, tier string, existing bigint, target bigint")
    asked = {r["class_id"]: r["n"] for r in planning.plan_single(counts).groupBy("class_id").agg(F.sum("size").alias("n")).collect()}
    assert asked == {c: 100 - (c - 1) * 20 for c in range(1, 6)}
    pools = {(r["pool"], r["class_id"]) for r in planning.eligible_pools(counts).collect()}
    assert ("groq", 2) not in pools and ("gemma4", 2) in pools and not any(c > 5 for _, c in pools)
    assert all(p != "mistral_code" for p, _ in pools)


def test_eighty_over_six_classes(spark):
    requests = spark.range(40).withColumnRenamed("id", "request_id")
    eligible = spark.createDataFrame([(c,) for c in range(1, 23)], "class_id int")
    sampled = planning.sample_k_classes(requests, eligible)
    assert sampled.groupBy("request_id").agg(F.countDistinct("class_id").alias("n")).filter("n <> 6").count() == 0
    rows = planning.allocate_mixed(sampled, n_classes=F.lit(6)).filter("request_id = 0").orderBy("place").collect()
    assert [r["quantity"] for r in rows] == [14, 14, 13, 13, 13, 13]


def test_language_draw_has_the_published_shares(spark):
    iso, _ = planning.sample_language(F.lit(9), F.col("id"))
    shares = {r["iso"]: r["n"] / 20000 for r in spark.range(20000).select(iso.alias("iso")).groupBy("iso").agg(F.count("*").alias("n")).collect()}
    assert all(abs(shares[i] - w / 100) < 0.015 for i, _, w, _ in dims.LANGUAGES)
    only = planning.sample_language(F.lit(13), F.col("id"))[0]
    assert spark.range(100).select(only.alias("iso")).distinct().collect()[0][0] == "en"


def test_progress_bar_and_quota(spark):
    counts = spark.createDataFrame([(1, "a", "1", 8000, 8000), (2, "b", "1", 9000, 8000), (3, "c", "2", 2799, 8000)], "class_id int, label string, tier string, existing bigint, target bigint")
    rows = {r["class_id"]: r for r in progress.progress(counts).collect()}
    assert (rows[2]["pct"], rows[2]["remaining"], rows[3]["pct"], rows[3]["bar"].rstrip()) == (100, 0, 34, "█" * 6)
    assert rows[1]["done"] and not rows[1]["all_done"] and rows[1]["classes_done"] == 2
    calls = spark.createDataFrame([(i, f"2024-01-0{1 + i // 40} 00:00:01", "gemini", "m", True) for i in range(60)], "call_id bigint, ts string, provider string, model string, ok boolean").withColumn("ts", F.col("ts").cast("timestamp"))
    models = spark.createDataFrame([("gemini", "m", None), ("gemini", "idle", 10), ("mistral", "free", None)], "provider string, model string, daily_limit int")
    status = {(r["day"], r["model"]): r for r in progress.quota_status(calls, models).collect()}
    assert status["2024-01-01", "m"]["exhausted"] and status["2024-01-01", "m"]["stop_at"] == 19 and not status["2024-01-01", "m"]["provider_stopped"]
    assert status["2024-01-02", "idle"]["calls"] == 0 and not status["2024-01-02", "free"]["exhausted"]
    assert [r["call_id"] for r in progress.first_exhaustion(calls, models, rows_per_bucket=7).orderBy("day").collect()] == [18, 58]


def test_a_cluster_without_a_shared_folder_is_refused():
    import pytest

    from dragoman.session import ensure_checkpoint_dir

    class Conf:
        get = staticmethod(lambda *a: None)

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: Conf)

    class Session:
        sparkContext, conf = Context, Conf
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session)
