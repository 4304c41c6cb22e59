"""Features are counted once for training and evaluation, and token counts hold for every code point."""

import sys

from pyspark.sql import functions as F

from dragoman.functions import text
from dragoman.operators import models

ROWS = [("one two three", 0, 0), ("four five six", 1, 1), ("", 0, 1), ("one two", 0, 0), ("five six 7", 1, 1)] * 4


SCHEMA = "text string, intent_label int, resource_label int"


def test_accuracy_counts_no_text_again(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text
    rows = spark.createDataFrame(ROWS * 20, SCHEMA).withColumn("text", seen("text"))
    model = models.train_two_head(rows, 64, 64, max_iter=3, accuracy=True)
    assert model.accuracy[0] == 1.0 and model.accuracy[0] == model.intent.summary.accuracy
    assert read.value == len(ROWS) * 20  # of each text once, the summaries included


def test_nothing_stays_persisted(spark):
    before = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    assert models.train_two_head(spark.createDataFrame(ROWS, SCHEMA), 64, 64, max_iter=2).accuracy is None
    assert set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) <= before


def test_evaluation_scores_a_row_once(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    found = models.evaluate_split(models.train_two_head(rows, 64, 64, max_iter=3), rows)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_chars" not in plan and "parquet" in plan and found.first()["accuracy_intent"] == 1.0


def test_every_code_point_separates_words_as_python_says(spark):
    points = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b" for c in points] + ["é你  　\U0001F600x \x85", "", " ", "　"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.token_count(F.col("t")).alias("n")).toArrow()
    assert [(t, n) for t, n in zip(*(c.to_pylist() for c in rows.columns)) if n != len(t.split())] == []


def test_common_characters_are_tried_before_the_class_of_all_whitespace(spark):
    plan = spark.range(1).select(text.token_count(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
    assert "[!-~[" in plan
