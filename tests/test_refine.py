import json

from pyspark.sql import functions as F

from dragoman.operators import filters, refine, split
from dragoman.plans import views
from dragoman.sources import answers, examples, sinks

GOOD = {"text": " turn it off ", "intent_class_id": 6, "intent_class_label": "ui_command", "language_iso": " EN ", "resource_class": "hr_global"}


def verify(spark, bodies, expected=None):
    df = spark.createDataFrame([(i, "p", "m", expected, b) for i, b in enumerate(bodies)],
                               "response_id bigint, provider string, model string, expected_class_id int, body string")
    return refine.verify_responses(df)


def reasons(spark, items, expected=None):
    rows = verify(spark, [json.dumps([item]) for item in items], expected).orderBy("response_id").collect()
    return [r["reason"] for r in rows]


def test_first_failing_rule_is_the_reason(spark):
    def but(**changes):
        return {**GOOD, **changes}

    missing = {k: v for k, v in GOOD.items() if k != "language_iso"}
    items = [GOOD, 5, "text", None, missing, but(text="  a "), but(text=7), but(intent_class_id="x"), but(intent_class_id=None),
             but(intent_class_id="3.0"), but(intent_class_id=99), but(intent_class_label="greeting_open"), but(language_iso="  "),
             but(language_iso=None), but(resource_class="planet"), but(resource_class=["hr_global"]), but(text="", intent_class_id=99)]
    assert reasons(spark, items) == [
        None, "not_an_object", "not_an_object", "not_an_object", "missing:language_iso", "bad_text", "bad_text",
        "class_id_not_int", "class_id_not_int", "class_id_not_int", "class_id_unknown", "label_mismatch", "bad_language",
        "bad_language", "bad_resource", "bad_resource", "bad_text"]


def test_class_ids_follow_python_int(spark):
    ids = ["6", " +6 ", 6.9, "1_0", True, 1e300, -6.5]
    labels = ["ui_command", "ui_command", "ui_command", "factoid_dynamic", "noise_gibberish", "ui_command", "ui_command"]
    items = [{**GOOD, "intent_class_id": i, "intent_class_label": label} for i, label in zip(ids, labels)]
    assert reasons(spark, items) == [None, None, None, None, None, "class_id_unknown", "class_id_unknown"]
    assert reasons(spark, [GOOD, items[4]], expected=6) == [None, "class_id_mismatch"]


def test_wrapped_broken_and_empty_answers(spark):
    good = json.dumps(GOOD)
    bodies = [f"```json\n[{good}]\n```", f"sure: [{good}] done", f"[{good}, {{\"text\": \"cut", '{"error": 1}', "no", None, "[]",
              f'{{"items": [{good}]}}', f"[{good}, {{broken}}, {good}]"]
    rows = verify(spark, bodies).groupBy("response_id").agg(
        F.count_if(F.col("status") == "valid").alias("ok"), F.max("answer_reason").alias("why"),
        F.bool_or("salvaged").alias("salvaged")).orderBy("response_id").collect()
    assert [(r["ok"], r["why"], r["salvaged"]) for r in rows[:6]] == [
        (1, None, False), (1, None, False), (1, None, True), (0, "not_a_list", False), (0, "parse_failed", False), (0, "no_answer", False)]
    assert [r["ok"] for r in rows[7:]] == [1, 2]


def test_normalised_and_tagged(spark):
    rows = refine.refine(spark.createDataFrame(
        [(1, "groq", "m1", None, json.dumps([{**GOOD, "generated_by": "hf:x"}, GOOD]))],
        "response_id bigint, provider string, model string, expected_class_id int, body string")).orderBy("item_no").collect()
    first = rows[0].asDict()
    assert (first["text"], first["tier"], first["language_iso"], first["split"]) == ("turn it off", "3", "en", "train")
    assert [(r["generated_by"], r["source_tag"]) for r in rows] == [("groq:m1", "hf:x"), ("groq:m1", "unknown")]


def test_every_item_is_valid_discarded_or_skipped(spark, sf_dir):
    checked = refine.verify_responses(views.raw_responses(spark, sf_dir))
    done = spark.createDataFrame([(c,) for c in range(1, 12)], "class_id int")
    marked = refine.mark_complete(checked, done)
    counts = {r["status"]: r["n"] for r in marked.groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == checked.count() and set(counts) == {"valid", "discard", "skipped_complete"}
    assert refine.log_first_discards(checked).groupBy("response_id").count().agg(F.max("count")).first()[0] == 3


def test_envelopes(spark):
    chat = json.dumps({"choices": [{"message": {"content": "[1]"}}]})
    parts = json.dumps({"candidates": [{"content": {"parts": [{"text": "[2]"}]}}]})
    df = spark.createDataFrame([("groq", chat), ("gemini", parts), ("gemini", chat), ("groq", "no json"), ("groq", '{"choices": []}')], "p string, e string")
    assert [r[0] for r in df.select(answers.extract_content(F.col("e"), F.col("p"))).collect()] == ["[1]", "[2]", None, None, None]


def test_external_length_border(spark):
    df = spark.createDataFrame([(1, 1, "0123456789", None), (1, 2, " 01234567890 ", None), (2, 1, "x" * 99, "short"), (2, 2, None, "y" * 11)],
                               "source_no int, row_no int, question string, prompt string")
    assert [(r["source_no"], r["text"]) for r in answers.cap_rows(answers.ingest_external(df), 5).collect()] == [(1, "01234567890"), (2, "y" * 11)]


def test_example_files_round_trip_and_report(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0, f"text {i}", 6, "ui_command", "3", "en", "hr_global", "p:m", "train") for i in range(20)],
                                 "response_id bigint, item_no int, text string, intent_class_id int, intent_class_label string, tier string, "
                                 "language_iso string, resource_class string, generated_by string, split string")
    folder = str(tmp_path / "out")
    sinks.write_examples(rows, folder)
    sinks.write_examples(rows, folder)  # append: a bag
    lines = examples.read_example_lines(spark, folder)
    assert lines.select("file_class_id").distinct().collect()[0][0] == 6
    assert examples.load_examples(lines).count() == 40
    sinks.write_examples(rows, folder + "2", batch_id=0)
    sinks.write_examples(rows, folder + "2", batch_id=0)  # replay: no duplicates
    assert examples.load_examples(examples.read_example_lines(spark, folder + "2")).count() == 20
    report = {r["class_id"]: r for r in examples.load_report(lines).collect()}
    assert report[6]["loaded"] == 40 and report[7]["file_status"] == "missing"


def test_bad_lines_are_skipped(spark):
    lines = ['{"text": "ok", "intent_class_label": "ui_command"}', "", "  ", "[1]", '{"text": 5, "intent_class_label": "ui_command"}',
             '{"text": null, "intent_class_label": "ui_command"}', '{"text": "x", "intent_class_label": "nope"}',
             '{"text": "r", "intent_class_label": "ui_command", "resource_class": "odd"}',
             '{"text": "r", "intent_class_label": "ui_command", "resource_class": []}', "{"]
    df = spark.createDataFrame([(6, i, s) for i, s in enumerate(lines)], "file_class_id int, line_no int, line string")
    assert sorted((r["text"], r["resource_label"]) for r in examples.load_examples(df).collect()) == [("ok", 0), ("r", 0)]
    six = [r for r in examples.load_report(df).collect() if r["class_id"] == 6][0]
    assert (six["loaded"], six["skipped"]) == (2, 6)


def test_token_filter_drops_unspaced_text_unless_its_language_is_wanted(spark):
    df = spark.createDataFrame([("你好世界这是一个问题", False, "zh"), ("hi", True, "en"), ("one two three four five six seven eight", False, "en")],
                               "text string, short_ok boolean, language_iso string")
    assert filters.min_token_filter(df).count() == 2
    assert filters.min_token_filter(df, language="zh").count() == 3


def test_quota_counts_from_what_exists(spark):
    rows = spark.createDataFrame([(i, 0, 1 if i % 3 else 2) for i in range(300)], "response_id bigint, item_no int, intent_class_id int")
    room = spark.createDataFrame([(1, 50), (2, 0)], "intent_class_id int, remaining bigint")
    kept = split.quota_cap(rows, room, "response_id", ["response_id", "item_no"], rows_per_bucket=20).collect()
    assert sorted(r["response_id"] for r in kept) == [i for i in range(300) if i % 3][:50]
