"""Two-head intent and resource classifier with MLlib: training, scoring, evaluation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, NGram, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from dragoman.functions.plan import through_table
from dragoman.operators import evaluate


@dataclass(frozen=True)
class TwoHeadModel:
    """Shared text features, one linear classifier per head, and their accuracy in training if asked for."""

    features: PipelineModel
    intent: object
    resource: object
    accuracy: list[float] | None = None


def feature_stages(word_features: int, char_features: int) -> list:
    """Words and character trigrams, hashed to a fixed width and weighted by rarity."""
    return [
        RegexTokenizer(inputCol="text", outputCol="_words", pattern=r"\s+", toLowercase=True),
        RegexTokenizer(inputCol="text", outputCol="_chars", pattern=".", gaps=False, toLowercase=True),
        NGram(n=3, inputCol="_chars", outputCol="_grams"),
        HashingTF(inputCol="_words", outputCol="_word_tf", numFeatures=word_features),
        HashingTF(inputCol="_grams", outputCol="_gram_tf", numFeatures=char_features),
        VectorAssembler(inputCols=["_word_tf", "_gram_tf"], outputCol="_tf"),
        IDF(inputCol="_tf", outputCol="features", minDocFreq=2),
    ]


def balance(examples: DataFrame, label: str, out: str) -> DataFrame:
    """Add a weight that makes every class count the same; class sizes are a small dimension."""
    sizes = examples.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    weights = sizes.select(label, (sizes.agg(F.avg("_n")).scalar() / F.col("_n")).alias(out))
    return examples.join(F.broadcast(weights), label)


def train_two_head(examples: DataFrame, word_features: int = 1 << 14, char_features: int = 1 << 14,
                   max_iter: int = 30, reg: float = 1e-4, accuracy: bool = False) -> TwoHeadModel:
    """Fit both heads on ``text, intent_label, resource_label``; with ``accuracy`` on the training rows too.

    L-BFGS over partitioned data; the gradient is tree-aggregated and its size depends on
    features x classes only. The feature table is persisted over the iterations and what is asked of the fits' summaries.
    """
    examples = examples.select("text", "intent_label", "resource_label").persist()
    features = Pipeline(stages=feature_stages(word_features, char_features)).fit(examples)
    table = features.transform(balance(balance(examples, "intent_label", "_w_intent"), "resource_label", "_w_resource"))
    table = table.select("features", "intent_label", "resource_label", "_w_intent", "_w_resource").persist()
    heads = [
        LogisticRegression(featuresCol="features", labelCol=f"{head}_label", weightCol=f"_w_{head}", family="multinomial",
                           maxIter=max_iter, regParam=reg, rawPredictionCol=f"_raw_{head}",
                           probabilityCol=f"_prob_{head}", predictionCol=f"_pred_{head}").fit(table)
        for head in ("intent", "resource")
    ]
    reached = [float(head.summary.accuracy) for head in heads] if accuracy else None  # a pass over the table, while it is there
    table.unpersist()
    examples.unpersist()
    return TwoHeadModel(features, *heads, reached)


def score_two_head(model: TwoHeadModel, rows: DataFrame) -> DataFrame:
    """Add logits ``la``, ``lb``; softmax and decoding follow as ordinary columns."""
    scored = model.resource.transform(model.intent.transform(model.features.transform(rows)))
    return scored.select(*rows.columns, vector_to_array("_raw_intent").alias("la"), vector_to_array("_raw_resource").alias("lb"))


def evaluate_split(model: TwoHeadModel, examples: DataFrame) -> DataFrame:
    """Loss, accuracy and macro F1 of both heads on labelled rows, as one row. The rows are scored once."""
    from dragoman.operators.scoring import softmax_argmax
    scored = softmax_argmax(score_two_head(model, examples.select("text", "intent_label", "resource_label"))).withColumns(
        {"ya": F.col("intent_label"), "yb": F.col("resource_label")})
    scored = through_table(scored, "scored")
    result = evaluate.two_head_loss(scored)
    for head in ("intent", "resource"):
        report = evaluate.classification_report(evaluate.confusion(scored, f"{head}_label", f"{head}_idx"))
        both = report.agg(F.struct(F.max("accuracy").alias("accuracy"), F.max("macro_f1").alias("macro_f1"))).scalar()
        result = result.withColumn("_m", both).withColumns({
            f"accuracy_{head}": F.col("_m.accuracy"), f"macro_f1_{head}": F.col("_m.macro_f1")}).drop("_m")
    return result
