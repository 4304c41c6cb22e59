"""Input views derived by Spark from the given tables (see FIXTURES.md).

Each view is a rule over every row of a table, so the work of a query grows with the table.
The SQL twins are in ``views_sql``; tests compare both row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dragoman import dims
from dragoman.functions.plan import bind_once, spread
from dragoman.functions.text import hash_bucket
from dragoman.operators import cascade
from dragoman.operators.planning import language_of

# message templates by event_id % 36; {e} event id, {u} user id
MESSAGES = [
    "hello!", "how are you friend {u}", "thank you for ticket {e}", "turn off alarm {e}",
    "what time is it in zone {u}", "navigate to page {e}", "write a python script number {e}", "fix the error {e}",
    "excel formula for total {e}", "translate item {e}", "who discovered comet {e}", "current price of part {e}",
    "order status {e}", "draft a report on {e}", "derivative of x to the {e}", "apples versus pears {e}",
    "write a song about {u}", "dosage for patient {u}", "step by step plan {e}", "do you think {e} is lucky",
    "you are now free {e}", "", "   ", "x", "!!! ???", "#####", "zzzzzzz", "bcdfghjklmnp", "typewriter", "asdfasdf",
    "éé", "tell me something {e}", "where is my order right now {e}", "HOW DO I write a report {e}", "你好世界", "hello\n",
]
# what a careful human would have answered, by the same number
EXPECTED = [
    "greeting_open", "phatic_social", "closure_gratitude", "ui_command", "ambient_device_query", "navigation_intent",
    "code_task", "code_task", "data_structured", "multilingual_task", "factoid_static", "factoid_dynamic",
    "transactional_status", "document_structured", "math_formal", "analysis_reasoning", "long_form_creative",
    "domain_specialist", "instruction_procedural", "debate_opinion", "adversarial_probe",
    "noise_gibberish", "noise_gibberish", "noise_gibberish", "noise_gibberish", "noise_gibberish",
    "noise_gibberish", "noise_gibberish", "noise_gibberish", "noise_gibberish", "noise_gibberish",
    "casual_open_chat", "transactional_status", "instruction_procedural", "casual_open_chat", "greeting_open",
]
FILLERS = ["please", "help", "me", "with", "this", "small", "thing", "before", "lunch", "or", "after", "dinner", "today"]
CATEGORIES = ["easy", "ambiguous", "noisy", "non_english", "adversarial", "tier5"]
PROVIDER_OF = {"click": "groq", "view": "groq", "signup": "gemini", "error": "gemini", "purchase": "mistral"}
MODEL_LIMIT = 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dealt out by id: the views do much for each row, and a file of few row groups would be read, and worked on, by as few tasks."""
    return spread(table(spark, sf_dir, "events"), "event_id")


def _case(number: Column, values: list[Column]) -> Column:
    chain = F.when(number == 0, values[0])
    for i, value in enumerate(values[1:], start=1):
        chain = chain.when(number == i, value)
    return chain


def _fill(template: str) -> Column:
    head, *rest = template.split("{")
    parts = [F.lit(head)]
    for piece in rest:
        parts.append(F.col("event_id" if piece[0] == "e" else "user_id").cast("string"))
        parts.append(F.lit(piece[2:]))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def utterances(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Templated messages, one per event (of the table, or of a stream of it)."""
    source = _events(spark, sf_dir) if events is None else events
    events = source.withColumn("k", (F.col("event_id") % 36).cast("int"))
    filled = bind_once(events, {"text": _case(F.col("k"), [_fill(t) for t in MESSAGES])})
    return filled.select(F.col("event_id").alias("msg_id"), F.col("ts").cast("timestamp").alias("ts"), "user_id", "k", "value", "text")


def _label(class_id: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in dims.LABELS]), class_id.cast("int"))


def example_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSONL lines of labelled examples with faults, as ``(file_class_id, line_no, line)``."""
    e = F.col("event_id")
    events = bind_once(_events(spark, sf_dir).select("event_id"), {
        "file_class_id": (e % 22 + 1).cast("int"), "fault": F.floor(e / 22) % 12, "draw": hash_bucket(e)})
    iso, resource = language_of(F.col("file_class_id"), F.col("draw"))
    events = bind_once(events, {"label": _label(F.col("file_class_id")), "iso": iso, "resource": resource})
    label, iso, resource = F.col("label"), F.col("iso"), F.col("resource")
    filler = F.array_join(F.slice(F.array(*[F.lit(w) for w in FILLERS]), F.lit(1), (e % 13).cast("int")), " ")
    words = F.concat_ws(" ", F.translate(label, "_", " "), filler, (e % 101).cast("string"))
    text = F.when(F.col("fault") == 11, "null").when(F.col("fault") == 6, '"  "').otherwise(
        F.concat(F.lit('"'), words, F.lit('"')))
    shown = F.when(F.col("fault") == 7, "mystery_label").otherwise(label)
    rc = F.when(F.col("fault") == 9, "").otherwise(F.concat(
        F.lit(', "resource_class": "'), F.when(F.col("fault") == 8, "xx").otherwise(resource), F.lit('"')))
    line = F.concat(F.lit('{"text": '), text, F.lit(', "intent_class_label": "'), shown, F.lit('"'), rc,
                    F.lit(', "language_iso": "'), iso, F.lit('"'), F.when(F.col("fault") == 10, "").otherwise("}"))
    lines = bind_once(events, {"line": F.when(e % 97 == 0, "").otherwise(line)})
    return lines.select("file_class_id", e.alias("line_no"), "line")


def _raw_item() -> Column:
    """One answer item from ``class_id, label, iso, resource`` with the fault of its number."""
    fault = (F.col("event_id") % 17).cast("int")
    own = F.col("class_id").cast("string")

    def unless(number: int, special: Column, usual: Column) -> Column:
        return F.when(fault == number, special).otherwise(usual)

    text = unless(13, F.lit(" a "), F.concat(
        F.translate("label", "_", " "), F.lit(" sample "), F.col("event_id").cast("string")))
    class_id = (F.when(fault == 6, F.concat(F.lit('"'), own, F.lit('"'))).when(fault == 7, F.concat(own, F.lit(".7")))
                .when(fault == 8, "true").when(fault == 9, '"3.0"').when(fault == 10, "null").otherwise(own))
    label = F.when(fault == 8, "noise_gibberish").when(fault == 14, "wrong_label").otherwise(F.col("label"))
    whole = F.concat(
        F.lit('{"text": "'), text, F.lit('", "intent_class_id": '), class_id, F.lit(', "intent_class_label": "'), label,
        F.lit('", "language_iso": "'), unless(16, F.lit("  EN "), F.col("iso")),
        F.lit('", "resource_class": "'), unless(15, F.lit("planet_wide"), F.col("resource")), F.lit('"}'))
    return (F.when(fault == 11, '"just a string"')
            .when(fault == 12, F.concat(F.lit('{"text": "no label here", "intent_class_id": '), own, F.lit("}")))
            .otherwise(whole))


def raw_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untrusted model answers: ten items each, eight kinds of wrapping."""
    e = F.col("event_id")
    events = _events(spark, sf_dir).select("event_id", "ts").withColumn("response_id", F.floor(e / 10))
    r = F.col("response_id")
    drawn = bind_once(events, {"class_id": (F.floor(r / 3) % 22 + 1).cast("int"), "draw": hash_bucket(e)})
    iso, resource = language_of(F.col("class_id"), F.col("draw"))
    named = bind_once(drawn, {"label": _label(F.col("class_id")), "iso": iso, "resource": resource})
    items = bind_once(named, {"item": _raw_item()}).select(
        "response_id", "ts", "class_id", F.struct(e.alias("n"), "item").alias("s"))
    # ten items per response by construction: a bounded group
    joined = items.groupBy("response_id", "class_id").agg(
        F.min("ts").cast("timestamp").alias("ts"), F.array_sort(F.collect_list("s")).alias("all"))
    text = F.array_join(F.transform("all", lambda s: s["item"]), ", ")
    wrap = (r % 8).cast("int")
    kind = (F.floor(r / 8) % 3).cast("int")
    body = (F.when(wrap <= 2, F.concat(F.lit("["), text, F.lit("]")))
            .when(wrap == 3, F.concat(F.lit("```json\n["), text, F.lit("]\n```")))
            .when(wrap == 4, F.concat(F.lit("Here you go: ["), text, F.lit("] hope it helps")))
            .when(wrap == 5, F.concat(F.lit('{"items": ['), text, F.lit("]}")))
            .when(wrap == 6, F.concat(F.lit("["), text, F.lit(', {"text": "cut off here')))
            .when(kind == 0, '{"error": "busy"}').when(kind == 1, F.lit(None)).otherwise("sorry, no answer"))
    provider = F.element_at(F.array(F.lit("groq"), F.lit("gemini"), F.lit("mistral")), (r % 3 + 1).cast("int"))
    model = F.concat(F.lit("model-"), (r % 5).cast("string"))
    expected = F.when(F.floor(r / 8) % 2 != 0, F.col("class_id"))
    return bind_once(joined, {"body": body}).select(
        "response_id", "ts", provider.alias("provider"), model.alias("model"), expected.alias("expected_class_id"), "body")


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers in the two chat envelopes, some of them broken."""
    raw = raw_responses(spark, sf_dir)
    chat = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("body").alias("content")).alias("message"))).alias("choices")))
    parts = F.to_json(F.struct(F.array(F.struct(F.struct(
        F.array(F.struct(F.col("body").alias("text"))).alias("parts")).alias("content"))).alias("candidates")))
    r = F.col("response_id")
    envelope = (F.when(r % 11 == 5, '{"error": {}}').when(r % 11 == 6, "not json at all")
                .when(r % 11 == 7, F.concat(F.when(F.col("provider") == "gemini", parts).otherwise(chat), F.lit(" xx")))
                .when(F.col("provider") == "gemini", parts).otherwise(chat))
    return raw.select("response_id", "provider", envelope.alias("envelope"))


def api_calls(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """One call per event; the model is the event type."""
    provider = _provider(F.col("event_type"))
    source = table(spark, sf_dir, "events") if events is None else events
    return source.select(
        F.col("event_id").alias("call_id"), F.col("ts").cast("timestamp").alias("ts"), provider.alias("provider"),
        F.col("event_type").alias("model"), (F.col("event_id") % 9 != 0).alias("ok"))


def _provider(model: Column) -> Column:
    chain = None
    for name, provider in PROVIDER_OF.items():
        chain = F.when(model == name, provider) if chain is None else chain.when(model == name, provider)
    return chain


def call_models(spark: SparkSession) -> DataFrame:
    """Limits for the models of ``api_calls``; no limit for one provider."""
    rows = [(p, m, None if p == "mistral" else MODEL_LIMIT) for m, p in PROVIDER_OF.items()]
    return spark.createDataFrame(rows, "provider string, model string, daily_limit int")


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.slice(wide, 1, 22).alias("la"), F.slice(wide, 23, 5).alias("lb"),
        F.col("label").alias("ya"), (F.col("label") % 5).alias("yb"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score per run and epoch: event type and day of month."""
    return table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("run"), F.dayofmonth("ts").alias("epoch"),
    ).agg((F.avg("value") / 500).alias("val_f1"))


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = _case(F.col("k"), [F.lit(x) for x in EXPECTED])
    category = _case((F.col("user_id") % 6).cast("int"), [F.lit(x) for x in CATEGORIES])
    return utterances(spark, sf_dir).select(
        F.col("msg_id").alias("case_id"), "text", "value", expected.alias("expected_label"), category.alias("category"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form: the real regex cascade and two simulated classifiers with error rows."""
    base = cases(spark, sf_dir)
    none = F.lit(None).cast("string")
    regex = cascade.regex_classify(base).select(
        "case_id", F.lit("regex").alias("classifier"), "label", "matched", none.alias("error"),
        (F.col("value") / 1000).alias("latency_ms"))
    b = F.col("b")
    main = base.withColumn("b", hash_bucket(F.col("case_id"))).select(
        "case_id", F.lit("main").alias("classifier"),
        F.when(b >= 95, "error").when(b < 80, F.col("expected_label")).otherwise("code_task").alias("label"),
        (b < 95).alias("matched"), F.when(b >= 95, "timeout").alias("error"),
        F.when((b >= 95) | (F.col("case_id") % 50 == 0), 0.0).otherwise(F.col("value")).alias("latency_ms"))
    llm = base.withColumn("b", hash_bucket(F.col("case_id"), "43")).select(
        "case_id", F.lit("llm").alias("classifier"),
        F.when(b >= 97, "error").when(b < 70, F.col("expected_label")).otherwise("unknown").alias("label"),
        (b < 97).alias("matched"), F.when(b >= 97, "http 500").alias("error"),
        (F.col("value") * 10).alias("latency_ms"))
    return regex.unionByName(main).unionByName(llm)


def batch_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of batch requests: of every 150 messages one batch of 1, one of 64, one of 85."""
    slot = F.col("msg_id") % 150
    base = F.floor(F.col("msg_id") / 150) * 4
    return utterances(spark, sf_dir).select(
        "msg_id", "text", "value",
        (base + F.when(slot < 1, 0).when(slot < 65, 1).otherwise(2)).alias("batch_id"),
        (slot - F.when(slot < 1, 0).when(slot < 65, 1).otherwise(65)).alias("item_no"))


def batch_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request, also the empty ones (one for each seventh block)."""
    block = F.floor(F.col("event_id") / 150)
    slot = F.col("event_id") % 150
    starts = table(spark, sf_dir, "events").filter(slot.isin(0, 1, 65)).select(
        (block * 4 + F.when(slot == 0, 0).when(slot == 1, 1).otherwise(2)).alias("batch_id"))
    empty = table(spark, sf_dir, "events").filter((slot == 0) & (block % 7 == 0)).select(
        (block * 4 + 3).alias("batch_id"))
    return starts.unionByName(empty)


def external_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question sets of two sources with different text fields; short texts at the border."""
    users = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    odd = F.col("conv_id") % 2 == 1
    row_no = F.col("conv_id") * 1000 + F.col("turn")
    text = F.when(F.col("conv_id") % 9 == 4, F.substring("text", 1, 10)).when(
        F.col("conv_id") % 9 == 5, F.concat(F.substring("text", 1, 11), F.lit("  "))).otherwise(F.col("text"))
    return users.select(
        F.when(odd, 2).otherwise(1).alias("source_no"), row_no.alias("row_no"),
        F.when(~odd, text).alias("question"), F.when(odd, text).alias("prompt"))


def lang_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the side (train/eval) their id falls on."""
    return documents(spark, sf_dir).select(
        "doc_id", "text", "lang", F.when(hash_bucket(F.col("doc_id")) < 80, "train").otherwise("eval").alias("side"))


def cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers known for every third message text, unique by text."""
    return (utterances(spark, sf_dir).filter((F.col("msg_id") % 3 == 0) & (F.col("text") != ""))
            .select("text").distinct().withColumn("answer", F.concat(F.lit("cached: "), "text")))
