"""Requests per pool, own resource classes, the gate in one pass, texts a model never sees, benchmark files."""

import json

import numpy as np
import pytest
from dragoman import dims
from dragoman.operators import gate, planning, refine, scoring
from dragoman.sources import sinks
from pyspark.sql import functions as F


def test_pools_close_each_deficit_together(spark):
    counts = spark.createDataFrame([(c, label, tier, 0, 7 * c if c != 5 else 0) for c, label, tier in dims.INTENTS],
                                   "class_id int, label string, tier string, existing bigint, target bigint")
    pools = spark.createDataFrame(list(dims.REQUEST_SIZES.items()), "pool string, request_size int")
    rows = planning.plan_pools(counts, pools).collect()
    asked = {}
    for r in rows:
        asked[r.class_id] = asked.get(r.class_id, 0) + r.size
        assert 0 < r.size <= dims.REQUEST_SIZES[r.pool]
    assert asked == {c: 7 * c for c, _, _ in dims.INTENTS if c != 5}
    may = {(r.pool, r.class_id) for r in dims.dim_pool_class(spark).collect()}
    assert {(r.pool, r.class_id) for r in rows} <= may
    assert {r.class_id for r in rows if r.pool == "mistral_code"} == {13, 14} and all(r.pool != "groq" for r in rows if r.class_id == 2)
    assert len({(r.pool, r.class_id, r.request_no) for r in rows}) == len(rows)
    # a pool of its own, with a rule of its own; a class that no pool may be asked for has no request
    own = planning.plan_pools(counts, spark.createDataFrame([("mine", 3)], "pool string, request_size int"),
                              spark.createDataFrame([("mine", 1), ("mine", 5)], "pool string, class_id int")).collect()
    assert sorted((r.class_id, r.request_no, r.size) for r in own) == [(1, 1, 3), (1, 2, 3), (1, 3, 1)]
    assert planning.plan_pools(counts.limit(0), pools).count() == 0


def test_own_resource_classes(spark):
    item = {"text": "hello there friend", "intent_class_id": 1, "intent_class_label": dims.INTENTS[0][1], "language_iso": "en", "resource_class": "mine"}
    parsed = spark.createDataFrame([(1, json.dumps([item, {**item, "resource_class": dims.RESOURCES[0]}, {**item, "resource_class": 7}]), None, None)],
                                   "response_id long, j string, answer_reason string, expected_class_id long")
    items = parsed.select("response_id", "answer_reason", "expected_class_id", F.posexplode(F.from_json("j", "array<variant>")).alias("item_no", "item"))
    own = spark.createDataFrame([(0, "mine"), (1, "mine")], "resource_idx int, resource_class string")
    for resources, want in ((own, [None, "bad_resource", "bad_resource"]), (None, ["bad_resource", None, "bad_resource"])):
        got = refine.verify_items(items, resources=resources).orderBy("item_no").collect()
        assert [r.reason for r in got] == want and [r.status for r in got] == ["discard" if w else "valid" for w in want]


def test_gate_is_one_pass_and_keeps_texts(spark):
    rows = spark.createDataFrame([(1, " tell me "), (2, None), (3, "  "), (4, "zzzzzz"), (5, "fine text"), (5, "fine text")], "id int, text string")

    def model(texts):
        assert texts.notna().all() and len(texts)
        return np.ones((len(texts), 2)), np.ones((len(texts), 2))

    def score(df):
        return scoring.score_udf(df, lambda: model, skip_nulls=True).withColumns({
            "intent_class_id": F.lit(9), "intent_class_label": F.col("text"), "resource_class": F.lit("r"), "confidence": F.lit(0.5), "source": F.lit("m")})

    got = gate.classify_with_gate(rows, score)
    assert got.columns[:3] == ["id", "text", "gate_rule"] and "_gate_text" not in got.columns
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    seen = sorted((r.id, r.text, r.intent_class_id, r.intent_class_label, r.confidence, r.source, r.la is None) for r in got.collect() if r.text is not None)
    assert seen == [(1, "tell me", 9, "tell me", 0.5, "m", False), (3, "  ", 1, "noise_gibberish", 1.0, "regex_gate", True),
                    (4, "zzzzzz", 1, "noise_gibberish", 1.0, "regex_gate", True), (5, "fine text", 9, "fine text", 0.5, "m", False), (5, "fine text", 9, "fine text", 0.5, "m", False)]
    assert [r.source for r in got.filter("id = 2").collect()] == ["regex_gate"]
    assert gate.classify_with_gate(rows.limit(0), score).count() == 0


def test_logits_of_null_texts(spark):
    rows = spark.createDataFrame([(k, None if k % 3 else f"t{k}") for k in range(50)] , "id int, text string").coalesce(1)
    load = lambda: lambda texts: (np.array([[float(t[1:])] for t in texts]), np.array([[1.0, 2.0]] * len(texts)))
    for r in scoring.score_udf(rows, load, skip_nulls=True).collect():
        assert (r.la, r.lb) == ((None, None) if r.id % 3 else ([float(r.id)], [1.0, 2.0]))


def test_benchmark_files(spark, tmp_path):
    judged = spark.createDataFrame([(1, "easy", "main", "a", "a", True, True, None, 1.5), (1, "easy", "llm", "a", "b", False, None, "late", None)],
        "case_id long, category string, classifier string, expected_label string, label string, correct boolean, matched boolean, error string, latency_ms double")
    report = spark.createDataFrame([('{"overall": {}}',)], "report string")
    assert sinks.write_benchmark(str(tmp_path), report, judged) == ["report", "cases"]
    cases = sorted((json.loads(r[0]) for r in spark.read.text(f"{tmp_path}/cases").collect()), key=lambda c: c["classifier"])
    assert cases[0]["error"] == "late" and cases[0]["latency_ms"] is None and cases[1]["answer"] == cases[1]["expected"] == "a"
    assert spark.read.text(f"{tmp_path}/report").collect()[0][0] == '{"overall": {}}'


@pytest.mark.parametrize("rows", [0, 1])
def test_adequacy_of_small_taxonomies(spark, rows):
    from dragoman.operators import progress
    counts = spark.createDataFrame([(1, "a", 5)][:rows], "class_id int, label string, existing bigint")
    assert [r.taxonomy_flag for r in progress.class_adequacy(counts).collect()] == ["too_few_classes"] * rows
