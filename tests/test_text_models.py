from pyspark.sql import functions as F

from dragoman.operators import language, models
from dragoman.operators.split import stratified_split
from dragoman.plans import views
from dragoman.plans.queries_refine import filtered


def test_language_scripts_short_text_and_profiles(spark, sf_dir):
    docs = views.lang_docs(spark, sf_dir)
    profile = language.language_profile(language.bigram_counts(docs.filter("side = 'train'")))
    odd = spark.createDataFrame([(1, "ab"), (2, None), (3, "مرحبا كيف حالك"), (4, "नमस्ते आप कैसे हैं"), (5, "你好世界"), (6, "a"), (7, "   ")], "id int, text string")
    rows = {r["id"]: (r["language_iso"], r["language_confidence"]) for r in language.detect_language(odd, profile).collect()}
    assert rows == {1: ("en", 0.0), 2: ("en", 0.0), 3: ("ar", 1.0), 4: ("hi", 1.0), 5: ("zh", 1.0), 6: ("en", 0.0), 7: ("en", 0.0)}
    held_out = language.detect_language(docs.filter((F.col("side") == "eval") & (F.length("text") > 60)), profile)
    right = held_out.agg(F.avg((F.col("lang") == F.col("language_iso")).cast("int"))).first()[0]
    assert right > 0.9


def test_two_heads_learn_the_templates(spark, sf_dir):
    parts = stratified_split(filtered(spark, sf_dir), "example_id", "class_id").persist()
    model = models.train_two_head(parts.filter("split = 'train'"), 1 << 10, 1 << 10, max_iter=10)
    scores = models.evaluate_split(model, parts.filter("split <> 'train'")).first()
    assert scores["accuracy_intent"] > 0.9 and scores["macro_f1_intent"] > 0.85 and scores["loss"] > 0
    empty = models.score_two_head(model, spark.createDataFrame([(1, "")], "id int, text string")).first()
    assert len(empty["la"]) == 22
