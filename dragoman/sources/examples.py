"""Labelled-example files: loading, load report, vocabulary and label files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dragoman import dims
from dragoman.functions.plan import bind_once
from dragoman.functions.text import py_strip
from dragoman.functions.variants import field, kind, text_of


def read_example_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of ``class_NN_label.jsonl`` files below ``folder``, with the class of the file name."""
    name = F.regexp_extract(F.col("_metadata.file_path"), r"class_(\d+)_", 1)
    return (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json*")
            .option("ignoreMissingFiles", "true").text(folder)
            .select(name.try_cast("int").alias("file_class_id"), F.col("value").alias("line")))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add ``text, label, resource, language_iso`` of non-blank lines; text null means unusable."""
    filled = lines.filter(py_strip(F.col("line")) != "")
    parsed = bind_once(filled, {"_doc": F.try_parse_json(py_strip(F.col("line")))}, drop=("line",))
    fields = bind_once(parsed, {
        "_text": field(F.col("_doc"), "text"), "_label": field(F.col("_doc"), "intent_class_label"),
        "_resource": field(F.col("_doc"), "resource_class"), "_iso": field(F.col("_doc"), "language_iso")}, drop=("_doc",))
    # an array or object cannot be looked up in the resource set: the line is unusable.
    # A document that is no object has no fields, so its text is null as well.
    usable = ~F.coalesce(kind(F.col("_resource")), F.lit("VOID")).isin("ARRAY", "OBJECT")
    text = F.when(usable, py_strip(text_of(F.col("_text"))))
    return bind_once(fields, {
        "text": F.nullif(text, F.lit("")), "label": text_of(F.col("_label")),
        "resource": text_of(F.col("_resource")), "language_iso": text_of(F.col("_iso")),
    }, drop=("_text", "_label", "_resource", "_iso"))


def load_examples(lines: DataFrame, intents: DataFrame | None = None, resources: DataFrame | None = None) -> DataFrame:
    """Usable examples with 0-based labels; unknown or missing resource falls back to the default.

    Keeps ``language_iso``, so a later filter can favour a language.
    """
    spark = lines.sparkSession
    intents = dims.dim_intent(spark) if intents is None else intents
    resources = dims.dim_resource(spark) if resources is None else resources
    default_idx = dims.RESOURCES.index(dims.DEFAULT_RESOURCE)
    parsed = parse_lines(lines).filter(F.col("text").isNotNull())
    return (
        parsed.join(F.broadcast(intents), "label")
        .join(F.broadcast(resources.withColumnRenamed("resource_class", "resource")), "resource", "left")
        .withColumn("resource_label", F.coalesce("resource_idx", F.lit(default_idx)))
        .withColumnRenamed("class_idx", "intent_label")
        .drop("resource", "resource_idx", "english_only")
    )


def load_report(lines: DataFrame, intents: DataFrame | None = None) -> DataFrame:
    """Loaded and skipped lines per class file; a class without a file shows ``missing``."""
    spark = lines.sparkSession
    intents = dims.dim_intent(spark) if intents is None else intents
    known = F.broadcast(intents.select("label", F.lit(True).alias("_known")))
    good = F.col("text").isNotNull() & F.col("_known").isNotNull()
    per = parse_lines(lines).join(known, "label", "left").groupBy("file_class_id").agg(
        F.count_if(good).alias("loaded"), F.count_if(~good).alias("skipped"))
    return intents.join(per, intents["class_id"] == per["file_class_id"], "left").select(
        "class_id", intents["label"], F.coalesce("loaded", F.lit(0)).alias("loaded"),
        F.coalesce("skipped", F.lit(0)).alias("skipped"),
        F.when(F.col("file_class_id").isNull(), "missing").otherwise("ok").alias("file_status"))


def write_labels_and_vocabulary(spark: SparkSession, folder: str, vocabulary: DataFrame,
                                metrics: DataFrame | None = None, history: DataFrame | None = None) -> list[str]:
    """Label maps, tokenizer table, metrics and history as files below ``folder``."""
    parts = {
        "labels/intent_classes": dims.dim_intent(spark).select("class_idx", "label"),
        "labels/resource_classes": dims.dim_resource(spark),
        "tokenizer/config": spark.createDataFrame(
            [(dims.VOCAB_SIZE, dims.MAX_TOKENS, 0, 2, 3)],
            "vocab_size int, max_seq_len int, pad_id int, cls_id int, sep_id int"),
        "test_results": metrics, "training_history": history,
    }
    written = []
    for name, df in parts.items():
        if df is not None:
            df.write.mode("overwrite").json(f"{folder}/{name}")
            written.append(name)
    vocabulary.write.mode("overwrite").parquet(f"{folder}/tokenizer/vocabulary")
    return [*written, "tokenizer/vocabulary"]
