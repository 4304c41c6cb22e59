"""Model answers in chat envelopes, and external question sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dragoman.functions.text import py_strip

# fixed values: where the two envelopes keep the answer
CHAT_PATH = "$.choices[0].message.content"
PARTS_PATH = "$.candidates[0].content.parts[0].text"
# fixed values: text field and name of the external question sets, by source number
EXTERNAL_SOURCES = [(1, "question", "LibrAI/do-not-answer"), (2, "prompt", "walledai/AdvBench")]
MIN_EXTERNAL_LENGTH = 10
#: Follows an envelope that is one whole JSON value.
END_MARK = "end of envelope"


def extract_content(envelope: Column, provider: Column) -> Column:
    """Answer text of the provider's envelope, null when it is broken or has no answer.

    The whole envelope must be JSON: text after it breaks it, as it does for a strict parser.
    """
    # the parser stops at the end of the first value, so the value is read as the first of two
    pair = F.try_parse_json(F.concat(F.lit("["), envelope, F.lit(f', "{END_MARK}"]')))
    whole = F.coalesce(F.try_variant_get(pair, "$[1]", "string") == END_MARK, F.lit(False))
    return F.when(whole & (provider == "gemini"), F.get_json_object(envelope, PARTS_PATH)).when(
        whole, F.get_json_object(envelope, CHAT_PATH))


def ingest_external(questions: DataFrame, sources: Sequence[tuple] = EXTERNAL_SOURCES) -> DataFrame:
    """Question sets as adversarial examples: texts over ten characters once stripped."""
    parts = []
    for source_no, column, name in sources:
        parts.append(questions.filter(F.col("source_no") == source_no).select(
            "source_no", "row_no", py_strip(F.col(column)).alias("text"),
            F.lit(2).alias("intent_class_id"), F.lit("adversarial_probe").alias("intent_class_label"),
            F.lit("1").alias("tier"), F.lit("en").alias("language_iso"), F.lit("hr_global").alias("resource_class"),
            F.lit(f"hf:{name}").alias("generated_by"), F.lit("train").alias("split")))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.filter(F.length("text") > MIN_EXTERNAL_LENGTH)


def cap_rows(examples: DataFrame, max_rows: int) -> DataFrame:
    """The first rows in source order, as a distributed top-k."""
    return examples.orderBy("source_no", "row_no").limit(max_rows)
