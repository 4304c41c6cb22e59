"""Queries that run the scalar helpers over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from dragoman import dims
from dragoman.functions import arrays, text, variants
from dragoman.operators import planning, refine
from dragoman.plans import views
from dragoman.plans.registry import query
from dragoman.plans.views_sql import RE2_WS, bucket, lit, pick_language, with_views


def _t(spark, sf_dir, name):
    return views.table(spark, sf_dir, name)


@query("f1_py_strip", with_views(
    "SELECT doc_id, md5(trim(chr(160) || chr(9) || text || chr(12288) || chr(10), (SELECT s FROM ws))) AS stripped FROM documents", "ws"))
def f1(spark, sf_dir):
    padded = F.concat(F.lit(" \t"), F.col("text"), F.lit("　\n"))
    return _t(spark, sf_dir, "documents").select("doc_id", F.md5(text.py_strip(padded)).alias("stripped"))


@query("f2_py_tokens",
       f"SELECT doc_id, len(t)::INT AS n_tokens, t[1] AS first_token, t[-1] AS last_token FROM (SELECT doc_id, regexp_extract_all(text, '[^{RE2_WS}]+') AS t FROM documents)")
def f2(spark, sf_dir):
    return views.documents(spark, sf_dir).withColumn("t", text.py_tokens(F.col("text"))).select(
        "doc_id", F.size("t").alias("n_tokens"), F.get("t", F.lit(0)).alias("first_token"),
        F.element_at("t", -1).alias("last_token"))


@query("f3_lower_upper", "SELECT conv_id, turn, md5(lower(text)) AS lowered, upper(role) AS role_up FROM conversations")
def f3(spark, sf_dir):
    return _t(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.md5(F.lower("text")).alias("lowered"), F.upper("role").alias("role_up"))


@query("f4_regex_match", with_views(
    "SELECT msg_id, regexp_matches(text, '(?i)how|what') AS found, regexp_full_match(text, '[a-z]+') AS whole, "
    "length(text) >= 5 AND replace(text, substr(text, 1, 1), '') = '' AS repeated FROM utterances", "utterances"))
def f4(spark, sf_dir):
    t = F.col("text")
    return views.utterances(spark, sf_dir).select(
        "msg_id", t.rlike(text.java_pattern("how|what", True)).alias("found"), t.rlike(r"^[a-z]+\z").alias("whole"),
        t.rlike(r"(?d)^(.)\1{4,}\z").alias("repeated"))


@query("f5_regex_replace", with_views(
    "SELECT response_id, regexp_replace(regexp_replace(body, '^```(?:json)?\\s*', ''), '\\s*```$', '') AS unfenced FROM raw_responses", "raw_responses"))
def f5(spark, sf_dir):
    body = F.regexp_replace(F.regexp_replace("body", r"^```(?:json)?\s*", ""), r"\s*```\z", "")
    return views.raw_responses(spark, sf_dir).select("response_id", body.alias("unfenced"))


@query("f6_char_set", with_views(
    "SELECT msg_id, CASE WHEN text = '' THEN 0 ELSE len(list_distinct(string_split(text, ''))) END::INT AS n_chars, text <> '' AND regexp_full_match(text, '[asdfghjkl]+') AS home_row FROM utterances", "utterances"))
def f6(spark, sf_dir):
    chars = text.distinct_chars(F.col("text"))
    row = F.array(*[F.lit(c) for c in "asdfghjkl"])
    full = F.col("text") != ""
    return views.utterances(spark, sf_dir).select(
        "msg_id", F.when(full, F.size(chars)).otherwise(0).alias("n_chars"),
        (full & (F.size(F.array_except(chars, row)) == 0)).alias("home_row"))


@query("f7_char_ratio",
       "SELECT doc_id, round(length(regexp_replace(text, '[^aeiou]', '', 'g'))::DOUBLE / nullif(length(text), 0), 6) AS vowels FROM documents")
def f7(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.round(text.char_ratio(F.col("text"), "aeiou"), 6).alias("vowels"))


@query("f8_json_access",
       "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, CASE json_type(props, '$.k') WHEN 'UBIGINT' THEN 'BIGINT' ELSE json_type(props, '$.k') END AS k_type, "
       "json_extract(props, '$.none') IS NULL AS absent FROM events")
def f8(spark, sf_dir):
    doc = _t(spark, sf_dir, "events").withColumn("v", F.try_parse_json("props"))
    k = variants.field(F.col("v"), "k")
    return doc.select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"), variants.kind(k).alias("k_type"),
                      variants.field(F.col("v"), "none").isNull().alias("absent"))


@query("f9_python_int", with_views(
    "SELECT response_id, item_no, class_id AS id FROM typed_items WHERE it = 'OBJECT'", "typed_items"))
def f9(spark, sf_dir):
    items = refine.explode_items(refine.parse_responses(views.raw_responses(spark, sf_dir)))
    return items.filter(variants.kind(F.col("item")) == "OBJECT").select(
        "response_id", "item_no", variants.python_int(variants.field(F.col("item"), "intent_class_id")).alias("id"))


@query("f10_array_maths", with_views(
    "SELECT row_id, round(list_sum(list_transform(la, lambda x: exp(x))), 6) AS total, round(list_max(la), 6) AS top, round(ln(list_sum(list_transform(la, lambda x: exp(x)))), 6) AS lse FROM logits", "logits"))
def f10(spark, sf_dir):
    total = F.aggregate("la", F.lit(0.0), lambda acc, x: acc + F.exp(x))
    return views.logits(spark, sf_dir).select(
        "row_id", F.round(total, 6).alias("total"), F.round(F.array_max("la"), 6).alias("top"), F.round(F.log(total), 6).alias("lse"))


@query("f11_round", "SELECT event_id, round(value, 1) AS one, round(value, 0) AS whole FROM events")
def f11(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", F.round("value", 1).alias("one"), F.round("value", 0).alias("whole"))


@query("f12_integer_maths",
       "SELECT event_id, ceil(value)::BIGINT AS up, floor(value)::BIGINT AS down, event_id % 7 AS rest, least(value, 10) AS low, greatest(0, 80 - event_id) AS room FROM events")
def f12(spark, sf_dir):
    e = F.col("event_id")
    return _t(spark, sf_dir, "events").select(
        "event_id", F.ceil("value").alias("up"), F.floor("value").alias("down"), (e % 7).alias("rest"),
        F.least(F.col("value"), F.lit(10.0)).alias("low"), F.greatest(F.lit(0).cast("bigint"), 80 - e).alias("room"))


@query("f13_percent",
       "SELECT user_id, round(count_if(event_type = 'error')::DOUBLE / greatest(count_if(event_type <> 'view'), 1) * 100, 1) AS pct FROM events GROUP BY 1")
def f13(spark, sf_dir):
    return _t(spark, sf_dir, "events").groupBy("user_id").agg(text.percent(
        F.count_if(F.col("event_type") == "error"), F.count_if(F.col("event_type") != "view")).alias("pct"))


@query("f14_utc_dates", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM events")
def f14(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    return _t(spark, sf_dir, "events").select("event_id", text.utc_day(ts).alias("day"), text.iso_utc(ts).alias("iso"))


@query("f15_formatting", with_views(
    "SELECT event_id, printf('class_%02d_%s', class_id, label) AS class_file, rpad(repeat('█', (event_id % 21)::INT), 20, ' ') AS bar, format('{:,}', event_id) AS shown "
    "FROM events JOIN dim_intent ON class_id = event_id % 22 + 1", "dim_intent"))
def f15(spark, sf_dir):
    e = F.col("event_id")
    rows = _t(spark, sf_dir, "events").select("event_id", (e % 22 + 1).cast("int").alias("class_id"))
    named = rows.join(F.broadcast(dims.dim_intent(spark)), "class_id")
    return named.select("event_id", dims.class_file(F.col("class_id"), F.col("label")).alias("class_file"),
                        F.rpad(F.repeat(F.lit("█"), (e % 21).cast("int")), 20, " ").alias("bar"), text.thousands(e).alias("shown"))


@query("f16_weighted_pick",
       "SELECT event_id, " + pick_language("(event_id % 22 + 1)", bucket("event_id"), 0) + " AS iso, "
       + pick_language("(event_id % 22 + 1)", bucket("event_id"), 1) + " AS resource_class FROM events")
def f16(spark, sf_dir):
    iso, resource = planning.sample_language((F.col("event_id") % 22 + 1).cast("int"), F.col("event_id"))
    return _t(spark, sf_dir, "events").select("event_id", iso.alias("iso"), resource.alias("resource_class"))


@query("f17_pad_truncate",
       "SELECT conv_id, turn, array_to_string([2] || ids || [3] || list_transform(range(14 - len(ids)), lambda x: 0), ',') AS input_ids, (len(ids) + 2)::INT AS used FROM ("
       f"SELECT conv_id, turn, list_transform(list_slice(regexp_extract_all(text, '[^{RE2_WS}]+'), 1, 14), lambda w: length(w)::INT) AS ids FROM conversations)")
def f17(spark, sf_dir):
    ids = F.transform(text.py_tokens(F.col("text")), F.length)
    padded, mask = arrays.fixed_length(ids, 16, 2, 3, 0)
    return _t(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.array_join(padded, ",").alias("input_ids"),
        F.aggregate(mask, F.lit(0), lambda a, x: a + x).alias("used"))


@query("f18_map_default", with_views(
    "SELECT msg_id, CASE label " + " ".join(f"WHEN {lit(a)} THEN {lit(b)}" for a, b in dims.TEMPLATES)
    + f" ELSE {lit(dims.DEFAULT_TEMPLATE)} END AS reply FROM cascade", "cascade"))
def f18(spark, sf_dir):
    from dragoman.operators.cascade import regex_classify
    replies = F.create_map(*[F.lit(x) for pair in dims.TEMPLATES for x in pair])
    return regex_classify(views.utterances(spark, sf_dir)).select(
        "msg_id", F.coalesce(F.try_element_at(replies, F.col("label")), F.lit(dims.DEFAULT_TEMPLATE)).alias("reply"))
