"""Model outputs to answers: softmax, decoding, top-k, batch requests, pluggable models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from dragoman import dims
from dragoman.functions.arrays import argmax, softmax, top_k
from dragoman.functions.plan import bind_once
from dragoman.operators.routing import route

MAX_BATCH = 64


def softmax_argmax(rows: DataFrame, intent: str = "la", resource: str = "lb") -> DataFrame:
    """Add probabilities, best index and confidence of both heads."""
    return bind_once(rows, {
        "probs_intent": softmax(F.col(intent)), "probs_resource": softmax(F.col(resource)),
    }).withColumns({
        "intent_idx": argmax(F.col("probs_intent")),
        "resource_idx": argmax(F.col("probs_resource")),
        "confidence_intent": F.round(F.array_max("probs_intent"), 4),
        "confidence_resource": F.round(F.array_max("probs_resource"), 4),
    })


def rounded(values: Column, places: int = 4) -> Column:
    return F.transform(values, lambda x: F.round(x, places))


def decode_prediction(scored: DataFrame, include_probs: Column | bool = False, intents: DataFrame | None = None,
                      resources: DataFrame | None = None, routes: DataFrame | None = None) -> DataFrame:
    """Indices to id, label, tier, resource class and action; probability arrays on request."""
    spark = scored.sparkSession
    intents = dims.dim_intent(spark) if intents is None else intents
    resources = dims.dim_resource(spark) if resources is None else resources
    wanted = include_probs if isinstance(include_probs, Column) else F.lit(include_probs)
    intent_dim = intents.select(
        F.col("class_idx").alias("intent_idx"), F.col("class_id").alias("intent_class_id"),
        F.col("label").alias("intent_class_label"), "tier")
    named = (scored.join(F.broadcast(intent_dim), "intent_idx")
             .join(F.broadcast(resources), "resource_idx"))
    routed = route(named, routes, label="intent_class_label", out="routing_action")
    return routed.withColumns({
        "probabilities_intent": F.when(wanted, rounded(F.col("probs_intent"))),
        "probabilities_resource": F.when(wanted, rounded(F.col("probs_resource"))),
    }).drop("probs_intent", "probs_resource")


def top_classes(rows: DataFrame, k: int, probs: str = "probs_intent", key: str = "row_id") -> DataFrame:
    """The ``k`` best classes per row, long form with a 1-based place. No shuffle."""
    best = F.posexplode(top_k(F.col(probs), k)).alias("place", "best")
    return rows.select(key, best).select(
        key, (F.col("place") + 1).alias("place"), F.col("best.idx").alias("class_idx"),
        F.col("best.value").alias("prob"))


def accept_batches(headers: DataFrame, items: DataFrame, limit: int = MAX_BATCH) -> tuple[DataFrame, DataFrame]:
    """Status per batch request and the items of accepted batches.

    ``headers(batch_id)`` lists every request, ``items(batch_id, item_no, ...)`` its texts with
    dense 0-based numbers. Counting combines map-side; items numbered ``limit`` or more only
    occur in refused batches and are dropped before any shuffle, so no batch, however
    large, sends more than ``limit`` rows anywhere.
    """
    counts = items.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_texts"))
    status = headers.join(counts, "batch_id", "left").select(
        "batch_id", F.coalesce("n_texts", F.lit(0)).alias("n_texts"),
        F.when(F.coalesce("n_texts", F.lit(0)) == 0, "empty")
        .when(F.col("n_texts") > limit, "too_many").otherwise("ok").alias("status"))
    accepted = (items.filter(F.col("item_no") < limit)
                .join(status.filter(F.col("status") == "ok").select("batch_id"), "batch_id", "left_semi"))
    return status, accepted


def batch_summary(status: DataFrame, results: DataFrame) -> DataFrame:
    """Per batch: results, count, total and mean latency. ``results`` has ``latency_ms``."""
    per = results.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("results"), F.round(F.sum("latency_ms"), 3).alias("total_ms"))
    return status.join(per, "batch_id", "left").select(
        "batch_id", "status", "n_texts", F.coalesce("results", F.lit(0)).alias("results"), "total_ms",
        F.round(F.col("total_ms") / F.col("results"), 3).alias("avg_ms"))


def score_udf(rows: DataFrame, load_model: Callable[[], Callable[[pd.Series], tuple[np.ndarray, np.ndarray]]],
              text: str = "text", skip_nulls: bool = False) -> DataFrame:
    """Score texts with any user model, Arrow batch by Arrow batch.

    ``load_model`` runs once per Python worker task and returns a function from a Series of
    texts to two logit matrices (n x intents, n x resources). Adds ``la`` and ``lb``. With
    ``skip_nulls`` the model never sees a null text, whose logits are then null.
    """
    @F.pandas_udf("la array<double>, lb array<double>")
    def logits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for texts in batches:
            given, out = texts.notna().to_numpy() | (not skip_nulls), pd.DataFrame({"la": [None] * len(texts), "lb": [None] * len(texts)}, dtype=object)
            if given.any():
                for name, logit in zip(("la", "lb"), model(texts[given])):
                    out.loc[given, name] = pd.Series(list(np.asarray(logit, dtype=float)), index=out.index[given], dtype=object)
            yield out

    return rows.withColumn("_logits", logits(F.col(text))).select(
        *rows.columns, F.col("_logits.la").alias("la"), F.col("_logits.lb").alias("lb"))
