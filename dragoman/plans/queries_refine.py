"""Queries over sources, gates, the cascade, routing and the refinery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dragoman import dims
from dragoman.functions.plan import through_table
from dragoman.functions.text import hash_bucket
from dragoman.functions.variants import kind
from dragoman.operators import cascade, dedup, evaluate, filters, gate, language, pattern_table, planning, progress, refine, routing, scoring, split, tokens
from dragoman.plans import views
from dragoman.plans.registry import query
from dragoman.plans.views_sql import (
    CASCADE_LABEL, NOISE_RULE, bucket, first_match, lit, pick_language, strip, with_views,
)
from dragoman.session import shared_folder
from dragoman.sources import answers, examples, sinks


def loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return examples.load_examples(views.example_lines(spark, sf_dir)).withColumnRenamed("line_no", "example_id")


def filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.min_token_filter(loaded(spark, sf_dir))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing examples per class after the length filter; the target is the mean class size."""
    return progress.with_target(progress.counted_classes(filtered(spark, sf_dir)))


# SQL for `counts`
COUNTS = ("(SELECT *, ceil(avg(existing) OVER ())::BIGINT AS target FROM (SELECT d.class_id, d.label, d.tier, d.english_only, "
          "count(f.class_id) AS existing FROM dim_intent d LEFT JOIN filtered f ON f.class_id = d.class_id GROUP BY ALL))")


def verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine.verify_responses(views.raw_responses(spark, sf_dir))


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.route(cascade.regex_classify(views.utterances(spark, sf_dir)))


# --- sources and sinks ---------------------------------------------------------------------
@query("s1_load_examples", with_views(
    "SELECT example_id, file_class_id, text, intent_label, resource_label, language_iso FROM examples", "examples"))
def s1(spark, sf_dir):
    return loaded(spark, sf_dir).select(
        "example_id", "file_class_id", "text", "intent_label", "resource_label", "language_iso")


@query("s2_load_examples_report", with_views(
    "SELECT d.class_id, d.label, coalesce(loaded, 0) AS loaded, coalesce(skipped, 0) AS skipped, "
    "CASE WHEN p.file_class_id IS NULL THEN 'missing' ELSE 'ok' END AS file_status FROM dim_intent d LEFT JOIN ("
    "SELECT file_class_id, count_if(good) AS loaded, count_if(NOT good) AS skipped FROM (SELECT file_class_id, "
    "coalesce(text, '') <> '' AND coalesce(label IN (SELECT label FROM dim_intent), false) AS good FROM parsed_lines) GROUP BY 1) p "
    "ON p.file_class_id = d.class_id", "parsed_lines", "dim_intent"))
def s2(spark, sf_dir):
    return examples.load_report(views.example_lines(spark, sf_dir))


@query("s3_extract_content", with_views(
    "SELECT response_id, CASE WHEN json_valid(envelope) THEN json_extract_string(envelope, CASE provider WHEN 'gemini' THEN "
    "'$.candidates[0].content.parts[0].text' ELSE '$.choices[0].message.content' END) END AS content FROM envelopes", "envelopes"))
def s3(spark, sf_dir):
    return views.envelopes(spark, sf_dir).select(
        "response_id", answers.extract_content(F.col("envelope"), F.col("provider")).alias("content"))


@query("s4_ingest_external", with_views(
    "SELECT source_no, row_no, text, generated_by, 2 AS intent_class_id FROM external", "external"))
def s4(spark, sf_dir):
    return answers.ingest_external(views.external_questions(spark, sf_dir)).select(
        "source_no", "row_no", "text", "generated_by", "intent_class_id")


@query("s5_write_examples", with_views(
    "SELECT printf('class_%02d_%s', intent_class_id, intent_class_label) AS class_file, count(*) AS n, "
    "sum(length(text))::BIGINT AS chars FROM refined GROUP BY 1", "refined"))
def s5(spark, sf_dir):
    folder = shared_folder(spark, "examples")
    sinks.write_examples(refine.refine(views.raw_responses(spark, sf_dir)), folder)
    return spark.read.schema("text string, class_file string").json(folder).groupBy("class_file").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query("s6_dataset_card", with_views(
    "SELECT class_id, '| ' || class_id || ' | ' || label || ' | ' || format('{:,}', existing) || ' | ' || format('{:,}', target) || ' | ' || "
    "CASE WHEN existing >= target THEN '✅' ELSE '🔄' END || ' |' AS line, 'Total examples: ' || format('{:,}', sum(existing) OVER ()::BIGINT) || ', status: ' || "
    f"CASE WHEN bool_and(existing >= target) OVER () THEN 'complete' ELSE 'running' END AS header FROM {COUNTS}", "filtered"))
def s6(spark, sf_dir):
    return progress.dataset_card(counts(spark, sf_dir))


@query("s8_write_vocab_and_labels", 
    "SELECT 'labels/intent_classes' AS name, 22::BIGINT AS n UNION ALL SELECT 'labels/resource_classes', 5 UNION ALL "
    "SELECT 'tokenizer/config', 1 UNION ALL SELECT 'tokenizer/vocabulary', least(count(*), 31995)::BIGINT FROM ("
    "SELECT w FROM (SELECT unnest(regexp_extract_all(text, '[^ \\t\\n\\r\\x0b\\x0c]+')) AS w FROM documents) GROUP BY w HAVING count(*) >= 2)")
def s8(spark, sf_dir):
    folder = shared_folder(spark, "labels")
    vocabulary = tokens.word_vocabulary(tokens.word_counts(views.documents(spark, sf_dir)))
    written = examples.write_labels_and_vocabulary(spark, folder, vocabulary)
    parts = []
    for name in written:
        path = f"{folder}/{name}"
        part = spark.read.parquet(path) if name == "tokenizer/vocabulary" else spark.read.json(path)
        parts.append(part.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n"))
    return refine.union_providers(*parts)


@query("s9_dims", with_views(
    "SELECT d.class_id, d.label, d.tier, d.short_ok, d.english_only, CASE WHEN d.label = 'adversarial_probe' THEN 'block' WHEN d.tier = '1' THEN 'drop' "
    "WHEN d.tier = '2' THEN 'static_template' WHEN d.tier = '3' THEN 'device_api' WHEN d.tier = '4' THEN 'cache_lookup' ELSE 'route_to_frontier' END AS action, "
    "count(c.msg_id) AS messages FROM dim_intent d LEFT JOIN cascade c ON c.label = d.label GROUP BY ALL", "cascade", "dim_intent"))
def s9(spark, sf_dir):
    seen = cascade.regex_classify(views.utterances(spark, sf_dir)).groupBy("label").agg(F.count(F.lit(1)).alias("messages"))
    listed = routing.route(dims.dim_intent(spark)).join(seen, "label", "left").na.fill(0, ["messages"])
    return listed.select("class_id", "label", "tier", "short_ok", "english_only", "action", "messages")


# --- gates, cascade, routing ---------------------------------------------------------------
@query("p1_gate_empty", with_views(
    "SELECT msg_id, coalesce(s, '') = '' AS gated, CASE WHEN s = '' THEN 1 END AS intent_class_id, CASE WHEN s = '' THEN 'noise_gibberish' END AS intent_class_label, "
    "CASE WHEN s = '' THEN '1' END AS tier, CASE WHEN s = '' THEN 'drop' END AS routing_action, CASE WHEN s = '' THEN 'noise_nonlinguistic' END AS resource_class, "
    "CASE WHEN s = '' THEN 1.0::DOUBLE END AS confidence_intent, CASE WHEN s = '' THEN 1.0::DOUBLE END AS confidence_resource, "
    "CASE WHEN s = '' THEN 'en' END AS language_iso, CASE WHEN s = '' THEN 0.0::DOUBLE END AS language_confidence FROM stripped", "stripped"))
def p1(spark, sf_dir):
    return gate.gate_empty(views.utterances(spark, sf_dir)).drop("ts", "user_id", "k", "value", "text")


@query("p1_gate_null_texts", with_views(
    "SELECT msg_id, gated, CASE WHEN gated THEN 'noise_gibberish' END AS intent_class_label, CASE WHEN gated THEN 'drop' END AS routing_action "
    "FROM (SELECT msg_id, msg_id % 5 = 0 OR s = '' AS gated FROM stripped)", "stripped"))
def p1_null(spark, sf_dir):
    """Every fifth message has lost its text."""
    rows = views.utterances(spark, sf_dir).select("msg_id", F.when(F.col("msg_id") % 5 != 0, F.col("text")).alias("text"))
    return gate.gate_empty(rows).select("msg_id", "gated", "intent_class_label", "routing_action")


@query("p2_gate_noise", with_views("SELECT msg_id, gate_rule FROM gate", "gate"))
def p2(spark, sf_dir):
    return gate.gate_noise(views.utterances(spark, sf_dir)).select("msg_id", "gate_rule")


def cascade_model(rows: DataFrame) -> DataFrame:
    """The cascade as the model behind the gate."""
    intents = dims.dim_intent(rows.sparkSession).select(
        F.col("class_id").alias("intent_class_id"), F.col("label").alias("intent_class_label"))
    labelled = cascade.regex_classify(rows).withColumnRenamed("label", "intent_class_label")
    return labelled.join(F.broadcast(intents), "intent_class_label", "left").withColumns({
        "resource_class": F.lit("hr_global"), "confidence": F.when(F.col("matched"), 1.0).otherwise(0.0),
        "source": F.lit("cascade")})


GATED = (
    "SELECT msg_id, CASE WHEN gate_rule IS NOT NULL THEN 1 ELSE d.class_id END AS intent_class_id, "
    "CASE WHEN gate_rule IS NOT NULL THEN 'noise_gibberish' ELSE x.label END AS intent_class_label, "
    "CASE WHEN gate_rule IS NOT NULL THEN 'noise_nonlinguistic' ELSE 'hr_global' END AS resource_class, "
    "CASE WHEN gate_rule IS NOT NULL OR x.label <> 'unknown' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS confidence, "
    "CASE WHEN gate_rule IS NOT NULL THEN 'regex_gate' ELSE 'cascade' END AS source FROM ("
    f"SELECT *, {CASCADE_LABEL} AS label FROM (SELECT *, {first_match('s')} AS rule_no FROM gate)) x LEFT JOIN dim_intent d ON d.label = x.label"
)


@query("p3_classify_with_gate", with_views(GATED, "gate", "dim_intent"))
def p3(spark, sf_dir):
    return gate.classify_with_gate(views.utterances(spark, sf_dir), cascade_model).select(
        "msg_id", "intent_class_id", "intent_class_label", "resource_class", "confidence", "source")


@query("p12_route", with_views("SELECT msg_id, label, tier, action FROM routed", "routed"))
def p12(spark, sf_dir):
    return routed(spark, sf_dir).select("msg_id", "label", "tier", "action")


@query("p13_dispatch", with_views(
    "SELECT msg_id, action, CASE action WHEN 'block' THEN 'I can''t help with that.' WHEN 'static_template' THEN CASE label "
    + " ".join(f"WHEN {lit(a)} THEN {lit(b)}" for a, b in dims.TEMPLATES) + f" ELSE {lit(dims.DEFAULT_TEMPLATE)} END "
    "WHEN 'cache_lookup' THEN answer END AS response, CASE action WHEN 'drop' THEN 'noise' WHEN 'block' THEN 'policy' END AS reason, "
    "CASE WHEN action = 'cache_lookup' AND answer IS NOT NULL THEN 'cache' END AS source, CASE WHEN action = 'device_api' THEN 'device_api' "
    "WHEN action = 'cache_lookup' AND answer IS NULL THEN 'micro_llm' WHEN action = 'route_to_frontier' THEN CASE WHEN rc = 'lr_emerging' THEN "
    + lit(dims.FRONTIER_MODELS["multilingual"]) + " WHEN tier = '5B' THEN " + lit(dims.FRONTIER_MODELS["reasoning"]) + " ELSE "
    + lit(dims.FRONTIER_MODELS["structured"]) + " END END AS handler FROM (SELECT r.*, c.answer, " + pick_language("0", bucket("user_id"), 1)
    + " AS rc FROM routed r LEFT JOIN cache c ON c.text = r.text)", "routed", "cache"))
def p13(spark, sf_dir):
    _, resource = planning.language_of(F.lit(0), hash_bucket(F.col("user_id")))
    routed_rows = routed(spark, sf_dir).withColumn("resource_class", resource)
    rows = through_table(routed_rows.select("msg_id", "text", "label", "tier", "action", "resource_class"), "routed")
    return routing.dispatch(rows, views.cache(spark, sf_dir)).select(
        "msg_id", "action", "response", "reason", "source", "handler")


@query("j5_regex_classify", with_views("SELECT msg_id, label, tier, matched FROM cascade", "cascade"))
def j5(spark, sf_dir):
    return cascade.regex_classify(views.utterances(spark, sf_dir)).select("msg_id", "label", "tier", "matched")


@query("j5_regex_classify_documents",
       f"SELECT doc_id, {CASCADE_LABEL} AS label FROM (SELECT doc_id, {first_match('text')} AS rule_no FROM documents)")
def j5_documents(spark, sf_dir):
    return cascade.regex_classify(views.documents(spark, sf_dir)).select("doc_id", "label")


@query("u2_union_gate_model", with_views(
    f"SELECT source, intent_class_label, count(*) AS n FROM ({GATED}) GROUP BY ALL", "gate", "dim_intent"))
def u2(spark, sf_dir):
    return gate.classify_with_gate(views.utterances(spark, sf_dir), cascade_model).groupBy(
        "source", "intent_class_label").agg(F.count(F.lit(1)).alias("n"))


@query("a12_routing_mix", with_views(
    "SELECT tier, action, n AS messages, round(n::DOUBLE / sum(n) OVER () * 100, 2) AS share_pct, CASE WHEN action = 'route_to_frontier' THEN 0 ELSE n END::BIGINT AS calls_avoided, "
    "round(n * 0.0002::DOUBLE, 6) AS cost_without, round(CASE WHEN action = 'route_to_frontier' THEN n ELSE 0 END * 0.0002::DOUBLE, 6) AS cost_with "
    "FROM (SELECT tier, action, count(*) AS n FROM routed GROUP BY ALL)", "routed"))
def a12(spark, sf_dir):
    return routing.routing_mix(routed(spark, sf_dir))


# --- refinery --------------------------------------------------------------------------------
#: Patterns of `j5_pattern_table`: the rarest of the most frequent long words, each as a word of its own.
TABLE_PATTERNS = 5000


def word_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pattern for each frequent ASCII word of the documents, the rarer ones first."""
    counted = tokens.word_counts(views.documents(spark, sf_dir)).filter(F.col("word").rlike("^[a-z]{4,}$"))
    top = counted.orderBy(F.desc("n"), "word").limit(TABLE_PATTERNS)
    return top.select((F.col("n")).alias("priority"), F.concat(F.lit(r"\b"), "word", F.lit(r"\b")).alias("pattern"), F.lit(True).alias("ignore_case"),
                      F.col("word").alias("label"), F.length("word").cast("string").alias("tier"))


@query("j5_pattern_table",
       f"WITH w AS (SELECT unnest(regexp_extract_all(text, '[^ \\t\\n\\r\\x0b\\x0c]+')) AS word FROM documents), "
       f"p AS (SELECT word, row_number() OVER (ORDER BY n, word) - 1 AS rule_no FROM (SELECT word, count(*) AS n FROM w WHERE regexp_full_match(word, '[a-z]{{4,}}') GROUP BY 1 HAVING count(*) >= 2 ORDER BY n DESC, word LIMIT {TABLE_PATTERNS})), "
       "h AS (SELECT doc_id, min(rule_no) AS rule_no FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+'))) AS word FROM documents) JOIN p USING (word) GROUP BY 1) "
       "SELECT doc_id, rule_no::INT AS rule_no, coalesce(word, 'unknown') AS label, coalesce(length(word)::VARCHAR, '?') AS tier FROM documents LEFT JOIN h USING (doc_id) LEFT JOIN p USING (rule_no)")
def j5_table(spark, sf_dir):
    found = pattern_table.classify_by_table(views.documents(spark, sf_dir), word_patterns(spark, sf_dir))
    return found.select("doc_id", "rule_no", "label", "tier")


@query("p4_clean_response", with_views("SELECT response_id, c AS cleaned FROM cleaned", "cleaned"))
def p4(spark, sf_dir):
    return views.raw_responses(spark, sf_dir).select(
        "response_id", refine.clean_response(F.col("body")).alias("cleaned"))


@query("p5_salvage_objects", with_views(
    "SELECT response_id, coalesce(len(blocks), 0)::INT AS n_objects FROM parsed", "parsed"))
def p5(spark, sf_dir):
    found = refine.salvage_objects(refine.clean_response(F.col("body")))
    return views.raw_responses(spark, sf_dir).select("response_id", F.coalesce(F.size(found), F.lit(0)).alias("n_objects"))


@query("p6_explode_items", with_views(
    "SELECT response_id, item_no, answer_reason, salvaged, CASE json_type(item) WHEN 'VARCHAR' THEN 'STRING' ELSE json_type(item) END AS item_kind FROM items", "items"))
def p6(spark, sf_dir):
    return refine.explode_items(refine.parse_responses(views.raw_responses(spark, sf_dir))).select(
        "response_id", "item_no", "answer_reason", "salvaged", kind(F.col("item")).alias("item_kind"))


@query("p7_verify_items", with_views("SELECT response_id, item_no, status, reason, class_id FROM verified", "verified"))
def p7(spark, sf_dir):
    return verified(spark, sf_dir).select("response_id", "item_no", "status", "reason", "class_id")


@query("p8_normalize_items", with_views(
    "SELECT response_id, item_no, text, intent_class_id, intent_class_label, tier, language_iso, resource_class, 'unknown' AS generated_by, 'train' AS split FROM refined", "refined"))
def p8(spark, sf_dir):
    return refine.normalize_items(verified(spark, sf_dir))


@query("p9_tag_provenance", with_views(
    "SELECT response_id, item_no, provider || ':' || model AS generated_by, 'unknown' AS source_tag FROM refined", "refined"))
def p9(spark, sf_dir):
    return refine.refine(views.raw_responses(spark, sf_dir)).select("response_id", "item_no", "generated_by", "source_tag")


@query("a3_discard_summary", with_views(
    "SELECT provider, reason, count(*) AS discards, grouping(provider, reason)::INT AS level FROM verified WHERE status = 'discard' "
    "GROUP BY GROUPING SETS ((provider, reason), (provider), ())", "verified"))
def a3(spark, sf_dir):
    return refine.discard_summary(verified(spark, sf_dir))


@query("a3_discards_per_answer", with_views(
    "SELECT response_id, count_if(status = 'valid') AS valid, count_if(status = 'discard') AS discards FROM verified GROUP BY 1", "verified"))
def a3_answers(spark, sf_dir):
    return refine.discards_per_answer(verified(spark, sf_dir))


@query("w7_log_first_discards", with_views(
    "SELECT response_id, item_no, reason, nth FROM (SELECT *, row_number() OVER (PARTITION BY response_id ORDER BY item_no)::INT AS nth "
    "FROM verified WHERE status = 'discard') WHERE nth <= 3", "verified"))
def w7(spark, sf_dir):
    return refine.log_first_discards(verified(spark, sf_dir)).select("response_id", "item_no", "reason", "nth")


# quota: half of the mean refined class size, minus what the class already has (class_id % 4 of it)
REFINED_QUOTA = ("(SELECT intent_class_id, (ceil(avg(n) OVER () / 2) * (intent_class_id % 4) / 3)::BIGINT AS remaining "
                 "FROM (SELECT intent_class_id, count(*) AS n FROM refined GROUP BY 1))")


@query("w2_quota_cap", with_views(
    "SELECT response_id, item_no, intent_class_id FROM (SELECT r.*, q.remaining, row_number() OVER ("
    f"PARTITION BY intent_class_id ORDER BY response_id, item_no) AS class_rank FROM refined r JOIN {REFINED_QUOTA} q USING (intent_class_id)) WHERE class_rank <= remaining", "refined"))
def w2(spark, sf_dir):
    rows = through_table(refine.refine(views.raw_responses(spark, sf_dir)), "refined")
    sizes = rows.groupBy("intent_class_id").agg(F.count(F.lit(1)).alias("n"))
    mean = sizes.agg(F.avg("n")).scalar()
    remaining = sizes.select("intent_class_id", F.round(
        F.ceil(mean / 2) * (F.col("intent_class_id") % 4) / 3).cast("bigint").alias("remaining"))
    return split.quota_cap(rows, remaining, "response_id", ["response_id", "item_no"]).select(
        "response_id", "item_no", "intent_class_id")


ARRIVALS = "(SELECT response_id, count_if(status = 'valid') AS valid FROM verified GROUP BY 1)"


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows each answer brings, in arrival order."""
    return through_table(refine.discards_per_answer(verified(spark, sf_dir)).select("response_id", "valid"), "arrivals")


@query("w3_checkpoint_batches_even", with_views(
    "SELECT response_id, ((greatest(sum(valid) OVER (ORDER BY response_id), 1) - 1) // 50)::BIGINT AS flush_no "
    f"FROM {ARRIVALS}", "verified"))
def w3_even(spark, sf_dir):
    return split.checkpoint_batches_even(arrivals(spark, sf_dir), [], "response_id", "valid", every=50, rows_per_bucket=128).select(
        "response_id", "flush_no")


def flush_sql(source: str, every: int, shard: str) -> str:
    """The sequential rule as a recursive CTE over arrivals numbered per shard."""
    return (f"a AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY response_id) AS i FROM (SELECT *, {shard} AS shard FROM {source})), "
            f"r AS (SELECT shard, i, response_id, valid, 0::BIGINT AS flush_no, valid >= {every} AS flushes, CASE WHEN valid >= {every} THEN 0 ELSE valid END AS held FROM a WHERE i = 1 "
            f"UNION ALL SELECT a.shard, a.i, a.response_id, a.valid, r.flush_no + r.flushes::INT, r.held + a.valid >= {every}, CASE WHEN r.held + a.valid >= {every} THEN 0 ELSE r.held + a.valid END "
            "FROM r JOIN a ON a.shard = r.shard AND a.i = r.i + 1)")


def with_flush(body: str, every: int, shard: str) -> str:
    base = with_views("", "verified").rstrip()
    return base.replace("WITH ", "WITH RECURSIVE ", 1) + ", " + flush_sql(ARRIVALS, every, shard) + " " + body


@query("w3_checkpoint_batches", with_flush("SELECT response_id, valid AS rows, flush_no, flushes FROM r", 50, "0"))
def w3(spark, sf_dir):
    return split.checkpoint_batches(arrivals(spark, sf_dir), "response_id", "valid", every=50, rows_per_bucket=128)


@query("u1_union_providers", with_views(
    "SELECT generated_by, count(*) AS n, count(DISTINCT text) AS texts FROM (SELECT provider || ':' || model AS generated_by, text FROM refined "
    "UNION ALL SELECT generated_by, text FROM external) GROUP BY 1", "refined", "external"))
def u1(spark, sf_dir):
    cols = ["text", "intent_class_id", "intent_class_label", "tier", "language_iso", "resource_class", "generated_by", "split"]
    merged = refine.union_providers(
        refine.refine(views.raw_responses(spark, sf_dir)).select(*cols),
        answers.ingest_external(views.external_questions(spark, sf_dir)).select(*cols))
    return merged.groupBy("generated_by").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("text").alias("texts"))


@query("t3_cap_rows", with_views(
    "SELECT source_no, row_no, text FROM external ORDER BY source_no, row_no LIMIT 100", "external"))
def t3(spark, sf_dir):
    return answers.cap_rows(answers.ingest_external(views.external_questions(spark, sf_dir)), 100).select(
        "source_no", "row_no", "text")


# --- filters, split, progress ----------------------------------------------------------------
@query("p10_min_token_filter", with_views("SELECT example_id, label, n_tokens::INT AS n_tokens FROM filtered", "filtered"))
def p10(spark, sf_dir):
    return filtered(spark, sf_dir).select("example_id", "label", "n_tokens")


@query("p11_min_token_filter_lang", with_views(
    "SELECT example_id, label, language_iso, n_tokens::INT AS n_tokens FROM tokens_counted WHERE n_tokens >= CASE WHEN short_ok OR language_iso = 'fr' THEN 1 ELSE 8 END", "tokens_counted"))
def p11(spark, sf_dir):
    return filters.min_token_filter(loaded(spark, sf_dir), language="fr").select(
        "example_id", "label", "language_iso", "n_tokens")


@query("w4_stratified_split", with_views(
    "SELECT example_id, CASE WHEN rk <= round(0.05::DOUBLE * n) THEN 'test' WHEN rk <= round(0.05::DOUBLE * n) + round(0.10::DOUBLE * n) THEN 'val' ELSE 'train' END AS split FROM ("
    "SELECT *, row_number() OVER (PARTITION BY class_id ORDER BY md5('42|' || example_id), example_id) AS rk, count(*) OVER (PARTITION BY class_id) AS n FROM filtered)", "filtered"))
def w4(spark, sf_dir):
    rows = through_table(filtered(spark, sf_dir).select("example_id", "class_id"), "filtered")
    return split.stratified_split(rows, "example_id", "class_id").select("example_id", "split")


@query("u3_dedup_exact", "SELECT min(doc_id) AS doc_id, lang, md5(text) AS text_md5, count(*) AS copies FROM documents GROUP BY lang, text")
def u3(spark, sf_dir):
    rows = views.documents(spark, sf_dir).select("doc_id", "lang", "text")
    return dedup.dedup_exact(rows, "text", ["lang"], "doc_id").select("doc_id", "lang", F.md5("text").alias("text_md5"), "copies")


_DOC_SPLIT = ("(SELECT doc_id, lang, text, CASE WHEN rk <= round(0.05::DOUBLE * n) THEN 'test' WHEN rk <= round(0.05::DOUBLE * n) + round(0.10::DOUBLE * n) THEN 'val' ELSE 'train' END AS split "
              "FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || doc_id), doc_id) AS rk, count(*) OVER (PARTITION BY lang) AS n FROM documents))")


@query("u3_split_overlap",
       f"WITH s AS MATERIALIZED {_DOC_SPLIT} SELECT lang, split, count(*) AS rows, count_if(EXISTS (SELECT 1 FROM s t WHERE t.split = 'train' AND t.lang = s.lang AND t.text = s.text)) AS in_train "
       "FROM s WHERE split <> 'train' GROUP BY 1, 2")
def u3_overlap(spark, sf_dir):
    rows = split.stratified_split(views.documents(spark, sf_dir).select("doc_id", "lang", "text"), "doc_id", "lang")
    return dedup.split_overlap(through_table(rows, "split"), "text", ["lang"])


@query("a1_class_counts", with_views(
    "SELECT d.class_id, d.label, (SELECT count(*) FROM examples e WHERE e.class_id = d.class_id) AS before, "
    "(SELECT count(*) FROM filtered f WHERE f.class_id = d.class_id) AS after, (SELECT count(*) FROM examples e WHERE e.class_id = d.class_id) - "
    "(SELECT count(*) FROM filtered f WHERE f.class_id = d.class_id) AS removed FROM dim_intent d", "filtered", "dim_intent"))
def a1(spark, sf_dir):
    rows = filters.with_token_count(loaded(spark, sf_dir))
    return progress.class_counts(rows, filters.enough_tokens(F.col("n_tokens")))


@query("a2_progress", with_views(
    "SELECT class_id, label, existing, target, existing >= target AS done, greatest(0, target - existing) AS remaining, pct::INT AS pct, "
    "rpad(repeat('█', pct::INT // 5), 20, ' ') AS bar, sum(existing) OVER ()::BIGINT AS total, count_if(existing >= target) OVER () AS classes_done, "
    f"bool_and(existing >= target) OVER () AS all_done FROM (SELECT *, least(100, floor(existing::DOUBLE / target * 100)) AS pct FROM {COUNTS})", "filtered"))
def a2(spark, sf_dir):
    return progress.progress(counts(spark, sf_dir))


@query("a13_language_mix", with_views(
    "SELECT class_id, language_iso, n AS rows, round(n::DOUBLE / sum(n) OVER (PARTITION BY class_id) * 100, 2) AS share_pct, "
    "CASE WHEN class_id IN (1, 2, 13, 14, 15, 16) THEN CASE WHEN language_iso = 'en' THEN 100 ELSE 0 END ELSE coalesce(weight, 0) END::INT AS target_pct "
    "FROM (SELECT class_id, language_iso, count(*) AS n FROM examples GROUP BY ALL) LEFT JOIN dim_language ON iso = language_iso", "examples", "dim_language"))
def a13(spark, sf_dir):
    return progress.language_mix(loaded(spark, sf_dir))


@query("a16_class_adequacy", with_views(
    "SELECT class_id, label, existing, CASE WHEN existing < 200 THEN 'too_small' WHEN existing < 400 THEN 'thin' WHEN existing < 800 THEN 'fair' ELSE 'good' END AS size_flag, "
    f"'ok' AS taxonomy_flag FROM {COUNTS}", "filtered"))
def a16(spark, sf_dir):
    return progress.class_adequacy(counts(spark, sf_dir), 200, 400, 800)


@query("a16_taxonomy_width",
    "SELECT taxonomy, class_id, label, existing, CASE WHEN existing < 40 THEN 'too_small' WHEN existing < 80 THEN 'thin' WHEN existing < 160 THEN 'fair' ELSE 'good' END AS size_flag, "
    "CASE WHEN count(*) OVER (PARTITION BY taxonomy) < 8 THEN 'too_few_classes' WHEN count(*) OVER (PARTITION BY taxonomy) > 25 THEN 'too_many_classes' ELSE 'ok' END AS taxonomy_flag FROM ("
    "SELECT 'type' AS taxonomy, min(event_id)::BIGINT AS class_id, event_type AS label, count(*) AS existing FROM events GROUP BY event_type UNION ALL "
    "SELECT 'day', extract(day FROM ts)::BIGINT, 'day ' || extract(day FROM ts), count(*) FROM events GROUP BY ALL UNION ALL "
    "SELECT 'user', user_id % 12, 'user ' || user_id % 12, count(*) FROM events GROUP BY ALL)")
def a16_width(spark, sf_dir):
    """Taxonomies of one's own over the events: too narrow, too wide and right."""
    events, n = views.table(spark, sf_dir, "events"), F.count(F.lit(1)).alias("existing")
    day, user = F.dayofmonth("ts").cast("long"), (F.col("user_id") % 12).cast("long")
    taxonomies = {
        "type": events.groupBy(F.col("event_type").alias("label")).agg(F.min("event_id").cast("long").alias("class_id"), n),
        "day": events.groupBy(day.alias("class_id")).agg(n).withColumn("label", F.concat(F.lit("day "), F.col("class_id").cast("string"))),
        "user": events.groupBy(user.alias("class_id")).agg(n).withColumn("label", F.concat(F.lit("user "), F.col("class_id").cast("string")))}
    parts = [progress.class_adequacy(rows, 40, 80, 160).select(F.lit(name).alias("taxonomy"), "*") for name, rows in taxonomies.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- joins --------------------------------------------------------------------------------------
@query("j1_inner_lookup", with_views(
    "SELECT event_id, d.class_id, d.label, d.tier FROM events JOIN dim_intent d ON d.class_id = event_id % 25", "dim_intent"))
def j1(spark, sf_dir):
    ids = views.table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 25).cast("int").alias("class_id"))
    return ids.join(F.broadcast(dims.dim_intent(spark)), "class_id").select("event_id", "class_id", "label", "tier")


@query("j2_left_with_default", with_views(
    "SELECT doc_id, lang, coalesce(l.resource_class, 'hr_global') AS resource_class FROM documents LEFT JOIN dim_language l ON iso = lang", "dim_language"))
def j2(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return language.iso_to_resource(docs, "lang").select("doc_id", "lang", "resource_class")


@query("j3_left_anti_complete", with_views(
    f"SELECT example_id, class_id FROM examples WHERE class_id NOT IN (SELECT class_id FROM {COUNTS} WHERE existing >= target)", "filtered"))
def j3(spark, sf_dir):
    done = counts(spark, sf_dir).filter(F.col("existing") >= F.col("target")).select("class_id")
    return loaded(spark, sf_dir).join(F.broadcast(done), "class_id", "left_anti").select("example_id", "class_id")


@query("j3_skip_complete", with_views(
    "SELECT status, count(*) AS n FROM (SELECT CASE WHEN status = 'valid' AND expected_class_id IS NULL AND class_id % 3 = 0 THEN 'skipped_complete' ELSE status END AS status FROM verified) GROUP BY 1", "verified"))
def j3_skip(spark, sf_dir):
    done = dims.dim_intent(spark).filter(F.col("class_id") % 3 == 0).select("class_id")
    return refine.mark_complete(verified(spark, sf_dir), done).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("j4_left_semi_valid", with_views(
    "SELECT line_no FROM parsed_lines WHERE rc IN (SELECT resource_class FROM dim_resource)", "parsed_lines", "dim_resource"))
def j4(spark, sf_dir):
    valid = dims.dim_resource(spark).select(F.col("resource_class").alias("resource"))
    return examples.parse_lines(views.example_lines(spark, sf_dir)).join(F.broadcast(valid), "resource", "left_semi").select("line_no")


_POOLS = [("groq", "class_id <> 2"), ("gemma4", "true"), ("gemini_flash", "true"), ("mistral_volume", "tier IN ('1', '2', '3', '4') AND class_id <> 2"),
          ("mistral_code", "class_id IN (13, 14)"), ("mistral_quality", "tier IN ('5A', '5B')")]


@query("j7_eligibility", with_views(" UNION ALL ".join(
    f"SELECT {lit(p)} AS pool, class_id, label, tier, existing, target FROM c WHERE existing < target AND {cond}" for p, cond in _POOLS
).replace("SELECT 'groq'", f", c AS (SELECT * FROM {COUNTS}) SELECT 'groq'", 1), "filtered").replace(") , c AS", "), c AS"))
def j7(spark, sf_dir):
    return planning.eligible_pools(counts(spark, sf_dir)).select("pool", "class_id", "label", "tier", "existing", "target")
