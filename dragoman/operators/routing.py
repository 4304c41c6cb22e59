"""From (tier, label) to an action, to the consumer's reply, to the traffic mix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dragoman import dims
from dragoman.functions.skew import salted_left_join


def route(rows: DataFrame, routes: DataFrame | None = None, tier: str = "tier", label: str = "label",
          out: str = "action") -> DataFrame:
    """Add the action: the label's route, else the tier's default, else the frontier.

    Routes are a dimension of a few rows per class; two broadcast left joins.
    """
    if routes is None:
        routes = dims.dim_route(rows.sparkSession)
    exact = routes.filter(F.col("label").isNotNull()).select(
        F.col("tier").alias("_t"), F.col("label").alias("_l"), F.col("action").alias("_exact"))
    by_tier = routes.filter(F.col("label").isNull()).select(
        F.col("tier").alias("_t2"), F.col("action").alias("_default"))
    return (
        rows.join(F.broadcast(exact), (F.col(tier) == F.col("_t")) & (F.col(label) == F.col("_l")), "left")
        .join(F.broadcast(by_tier), F.col(tier) == F.col("_t2"), "left")
        .withColumn(out, F.coalesce("_exact", "_default", F.lit(dims.DEFAULT_ACTION)))
        .drop("_t", "_l", "_t2", "_exact", "_default")
    )


def frontier_model(resource: Column, tier: Column, names: dict = dims.FRONTIER_MODELS) -> Column:
    return (F.when(resource == "lr_emerging", names["multilingual"])
            .when(tier == "5B", names["reasoning"])
            .otherwise(names["structured"]))


def dispatch(routed: DataFrame, cache: DataFrame, templates: DataFrame | None = None, text: str = "text",
             row_id: str = "msg_id", hot_rows: int = 1_000_000) -> DataFrame:
    """What the consumer does with each routed message.

    ``routed`` has ``action, label, tier, resource_class``; ``cache(text, answer)`` is unique
    by text and may be large. Only ``cache_lookup`` rows enter the cache join, and a text
    asked very often is salted. ``routed`` is read once per branch and once to find hot texts,
    so it should be a stored table. Adds ``response, reason, source, handler``.
    """
    if templates is None:
        templates = dims.dim_template(routed.sparkSession)
    lookups = routed.filter(F.col("action") == "cache_lookup")
    others = routed.filter(F.col("action") != "cache_lookup").withColumn("answer", F.lit(None).cast("string"))
    answers = cache.select(F.col("text").alias(text), "answer")
    looked_up = salted_left_join(lookups, answers, text, [row_id], hot_rows=hot_rows)
    rows = looked_up.unionByName(others).join(F.broadcast(templates), "label", "left")
    action = F.col("action")
    return rows.withColumns({
        "response": F.when(action == "block", dims.BLOCK_REPLY)
        .when(action == "static_template", F.coalesce("reply", F.lit(dims.DEFAULT_TEMPLATE)))
        .when(action == "cache_lookup", F.col("answer")),
        "reason": F.when(action == "drop", "noise").when(action == "block", "policy"),
        "source": F.when((action == "cache_lookup") & F.col("answer").isNotNull(), "cache"),
        "handler": F.when(action == "device_api", "device_api")
        .when((action == "cache_lookup") & F.col("answer").isNull(), "micro_llm")
        .when(action == "route_to_frontier", frontier_model(F.col("resource_class"), F.col("tier"))),
    }).drop("reply", "answer")


def routing_mix(routed: DataFrame, unit_cost: float = 0.0002) -> DataFrame:
    """Traffic share per tier and action, frontier calls, cost with and without routing."""
    per = routed.groupBy("tier", "action").agg(F.count(F.lit(1)).alias("messages"))
    # at most tiers x actions rows reach this window
    whole = Window.partitionBy(F.lit(0))
    frontier = F.col("action") == "route_to_frontier"
    return per.withColumn("total", F.sum("messages").over(whole)).select(
        "tier", "action", "messages",
        F.round(F.col("messages") / F.col("total") * 100, 2).alias("share_pct"),
        F.when(frontier, F.lit(0)).otherwise(F.col("messages")).cast("bigint").alias("calls_avoided"),
        F.round(F.col("messages") * F.lit(unit_cost), 6).alias("cost_without"),
        F.round(F.when(frontier, F.col("messages")).otherwise(F.lit(0)) * F.lit(unit_cost), 6).alias("cost_with"),
    )
