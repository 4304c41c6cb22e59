"""Label-data refinery: raw model answers to verified, normalised, tagged examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dragoman import dims
from dragoman.functions.plan import bind_once
from dragoman.functions.text import py_strip
from dragoman.functions.variants import field, kind, python_int, text_of

# fixed values: required fields, in the order they are looked for
REQUIRED = ["text", "intent_class_id", "intent_class_label", "language_iso", "resource_class"]
MIN_TEXT = 3


def clean_response(body: Column) -> Column:
    """Strip, drop a leading and a trailing code fence, clip to the outermost ``[`` and ``]``."""
    text = py_strip(body)
    text = F.regexp_replace(text, r"(?U)^```(?:json)?[\s\x1c-\x1f]*", "")
    text = F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]*```\z", "")
    text = py_strip(text)
    text = F.regexp_replace(text, r"^[^\[]++(?=\[)", "")
    return F.regexp_replace(text, r"\][^\]]*\z", "]")


def salvage_objects(text: Column) -> Column:
    """Every parseable flat ``{...}`` of a broken answer as array of Variant; null when none."""
    blocks = F.regexp_extract_all(text, F.lit(r"\{[^{}]+\}"), F.lit(0))
    parsed = F.filter(F.transform(blocks, F.try_parse_json), lambda v: v.isNotNull())
    return F.when(F.size(parsed) > 0, parsed)


def parse_responses(responses: DataFrame, body: str = "body") -> DataFrame:
    """Add ``items`` (array of Variant or null), ``salvaged`` and ``answer_reason``.

    ``answer_reason`` is why an answer has no items: ``no_answer``, ``parse_failed`` or
    ``not_a_list``.
    """
    cleaned = bind_once(responses, {"_clean": clean_response(F.col(body))})
    parsed = bind_once(cleaned, {"_parsed": F.try_parse_json("_clean")})
    listed = bind_once(parsed, {
        "_list": F.try_variant_get("_parsed", "$", "array<variant>"),
        "_salvage": F.when(F.col("_parsed").isNull(), salvage_objects(F.col("_clean"))),
    })
    return listed.withColumns({
        "items": F.coalesce("_list", "_salvage"),
        "salvaged": F.col("_parsed").isNull() & F.col("_salvage").isNotNull(),
        "answer_reason": F.when(F.col(body).isNull(), "no_answer")
        .when(F.coalesce("_list", "_salvage").isNotNull(), F.lit(None))
        .when(F.col("_parsed").isNull(), "parse_failed").otherwise("not_a_list"),
    }).drop("_clean", "_parsed", "_list", "_salvage")


def explode_items(parsed: DataFrame) -> DataFrame:
    """One row per item with its position; answers without items keep one row with a null item."""
    kept = [c for c in parsed.columns if c != "items"]
    return parsed.select(*kept, F.posexplode_outer("items").alias("item_no", "item"))


def verify_items(exploded: DataFrame, intents: DataFrame | None = None, resources: DataFrame | None = None) -> DataFrame:
    """Add the typed fields, ``status`` (valid/discard) and the first failing rule as ``reason``.

    ``expected_class_id`` null means mixed mode. The taxonomy and the resource classes are broadcast
    dimensions, so different ones are just other DataFrames. Ill-typed values are reasons, never errors.
    """
    intents = dims.dim_intent(exploded.sparkSession) if intents is None else intents
    resources = dims.dim_resource(exploded.sparkSession) if resources is None else resources
    fields = bind_once(exploded, {
        **{f"_{name}": field(F.col("item"), name) for name in REQUIRED}, "_generated_by": field(F.col("item"), "generated_by")})
    typed = bind_once(fields, {
        "_item_kind": kind(F.col("item")),
        "item_text": text_of(F.col("_text")),
        "class_id": python_int(F.col("_intent_class_id")),
        "item_label": text_of(F.col("_intent_class_label")),
        "item_iso": text_of(F.col("_language_iso")),
        "item_resource": text_of(F.col("_resource_class")),
        "item_source": text_of(F.col("_generated_by")),
    })
    dim = intents.select(F.col("class_id").cast("bigint").alias("class_id"),
                         F.col("label").alias("class_label"), F.col("tier").alias("class_tier"))
    joined = typed.join(F.broadcast(dim), "class_id", "left")
    known = resources.select(F.col("resource_class").alias("item_resource"), F.lit(True).alias("_known_resource")).distinct()
    joined = joined.join(F.broadcast(known), "item_resource", "left")
    reason = (F.when(F.col("answer_reason").isNotNull(), F.col("answer_reason"))
              .when(F.coalesce(F.col("_item_kind"), F.lit("VOID")) != "OBJECT", "not_an_object"))
    for name in REQUIRED:
        reason = reason.when(F.col(f"_{name}").isNull(), f"missing:{name}")
    reason = (
        reason
        .when(F.coalesce(F.length(py_strip(F.col("item_text"))), F.lit(0)) < MIN_TEXT, "bad_text")
        .when(F.col("class_id").isNull(), "class_id_not_int")
        .when(F.col("class_label").isNull(), "class_id_unknown")
        .when(F.col("expected_class_id").isNotNull() & (F.col("class_id") != F.col("expected_class_id")),
              "class_id_mismatch")
        .when(~F.coalesce(F.col("item_label") == F.col("class_label"), F.lit(False)), "label_mismatch")
        .when(F.coalesce(py_strip(F.col("item_iso")), F.lit("")) == "", "bad_language")
        .when(F.col("_known_resource").isNull(), "bad_resource")
    )
    checked = bind_once(joined, {"reason": reason})
    return checked.withColumn("status", F.when(F.col("reason").isNull(), "valid").otherwise("discard")).drop(
        *[f"_{name}" for name in REQUIRED], "_generated_by", "_item_kind", "_known_resource")


def verify_responses(responses: DataFrame, intents: DataFrame | None = None, resources: DataFrame | None = None) -> DataFrame:
    return verify_items(explode_items(parse_responses(responses)), intents, resources)


def normalize_items(verified: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Valid items as labelled examples; ``keep`` names id columns to carry along."""
    keep = ["response_id", "item_no"] if keep is None else keep
    return verified.filter(F.col("status") == "valid").select(
        *keep,
        py_strip(F.col("item_text")).alias("text"),
        F.col("class_id").cast("int").alias("intent_class_id"),
        F.col("class_label").alias("intent_class_label"),
        F.col("class_tier").alias("tier"),
        F.lower(py_strip(F.col("item_iso"))).alias("language_iso"),
        F.col("item_resource").alias("resource_class"),
        F.coalesce("item_source", F.lit("unknown")).alias("generated_by"),
        F.lit("train").alias("split"),
    )


def tag_provenance(examples: DataFrame, provider: str = "provider", model: str = "model") -> DataFrame:
    """``generated_by`` becomes ``provider:model``; the former value moves to ``source_tag``."""
    return examples.withColumn("source_tag", F.col("generated_by")).withColumn(
        "generated_by", F.concat_ws(":", provider, model))


def refine(responses: DataFrame, intents: DataFrame | None = None, done: DataFrame | None = None) -> DataFrame:
    """Raw answers to tagged examples in one pass without a shuffle.

    Mixed-mode items of the classes in ``done(class_id)`` are skipped.
    """
    keep = ["response_id", "item_no", "provider", "model"]
    checked = verify_responses(responses, intents)
    checked = checked if done is None else mark_complete(checked, done)
    return tag_provenance(normalize_items(checked, keep)).drop("provider", "model")


def mark_complete(verified: DataFrame, done: DataFrame) -> DataFrame:
    """Mixed-mode items of classes in ``done(class_id)`` get status ``skipped_complete``."""
    flag = done.select(F.col("class_id").cast("bigint").alias("class_id"), F.lit(True).alias("_done"))
    skipped = (F.col("status") == "valid") & F.col("expected_class_id").isNull() & F.col("_done")
    return (verified.join(F.broadcast(flag), "class_id", "left")
            .withColumn("status", F.when(skipped, "skipped_complete").otherwise(F.col("status"))).drop("_done"))


def discard_summary(verified: DataFrame) -> DataFrame:
    """Discards by provider and reason with subtotals, in one grouping-sets pass."""
    bad = verified.filter(F.col("status") == "discard")
    return bad.groupingSets(
        [["provider", "reason"], ["provider"], []], "provider", "reason",
    ).agg(F.count(F.lit(1)).alias("discards"),
          F.grouping_id().cast("int").alias("level"))


def discards_per_answer(verified: DataFrame) -> DataFrame:
    return verified.groupBy("response_id").agg(
        F.count_if(F.col("status") == "valid").alias("valid"),
        F.count_if(F.col("status") == "discard").alias("discards"))


def log_first_discards(verified: DataFrame, first: int = 3) -> DataFrame:
    """The first few discards of each answer. The rank limit is applied before the shuffle too."""
    order = Window.partitionBy("response_id").orderBy("item_no")
    return (verified.filter(F.col("status") == "discard")
            .withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= first))


def union_providers(*parts: DataFrame) -> DataFrame:
    """Bag union of example sets; duplicates stay."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged
