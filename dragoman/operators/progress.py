"""Progress, usage and quota derived from facts instead of mutated state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dragoman import dims
from dragoman.functions.ranking import ROWS_PER_BUCKET, range_of, ranked
from dragoman.functions.text import thousands, utc_day


def class_counts(examples: DataFrame, kept: Column, class_id: str = "class_id") -> DataFrame:
    """Examples per class before and after filtering by ``kept``, zero classes included; one pass."""
    intents = dims.dim_intent(examples.sparkSession).select("class_id", "label")
    per = examples.groupBy(F.col(class_id).alias("class_id")).agg(
        F.count(F.lit(1)).alias("before"), F.count_if(kept).alias("after"))
    filled = intents.join(per, "class_id", "left").na.fill(0, ["before", "after"])
    return filled.withColumn("removed", F.col("before") - F.col("after"))


def counted_classes(examples: DataFrame, class_id: str = "class_id") -> DataFrame:
    """``existing`` per class of the taxonomy, zero classes included."""
    intents = dims.dim_intent(examples.sparkSession)
    per = examples.groupBy(F.col(class_id).alias("class_id")).agg(F.count(F.lit(1)).alias("existing"))
    return intents.join(per, "class_id", "left").na.fill(0, ["existing"])


def with_target(counts: DataFrame, target: int | None = None) -> DataFrame:
    """Add ``target``: the given number, or the mean class size (bring small classes up to it)."""
    if target is not None:
        return counts.withColumn("target", F.lit(target).cast("bigint"))
    whole = Window.partitionBy(F.lit(0))  # a row per class
    return counts.withColumn("target", F.ceil(F.avg("existing").over(whole)))


def progress(counts: DataFrame) -> DataFrame:
    """Per class: count, done, remaining, percent and bar; plus the overall columns.

    ``counts(class_id, label, existing, target)`` has a row per class.
    """
    whole = Window.partitionBy(F.lit(0))
    pct = F.least(F.lit(100), F.floor(F.col("existing") / F.col("target") * 100)).cast("int")
    done = F.col("existing") >= F.col("target")
    return counts.select(
        "class_id", "label", "existing", "target", done.alias("done"),
        F.greatest(F.lit(0), F.col("target") - F.col("existing")).alias("remaining"), pct.alias("pct"),
        F.rpad(F.repeat(F.lit("█"), F.floor(pct / 5).cast("int")), 20, " ").alias("bar"),
        F.sum("existing").over(whole).alias("total"),
        F.count_if(done).over(whole).alias("classes_done"),
        F.bool_and(done).over(whole).alias("all_done"))


def dataset_card(counts: DataFrame, status: str = "running") -> DataFrame:
    """Progress table lines in class order, each with the header totals."""
    p = progress(counts)
    mark = F.when(F.col("done"), "✅").otherwise("🔄")
    line = F.concat(F.lit("| "), F.col("class_id").cast("string"), F.lit(" | "), F.col("label"), F.lit(" | "),
                    thousands(F.col("existing")), F.lit(" | "), thousands(F.col("target")), F.lit(" | "), mark, F.lit(" |"))
    header = F.concat(F.lit("Total examples: "), thousands(F.col("total")), F.lit(", status: "),
                      F.when(F.col("all_done"), "complete").otherwise(status))
    return p.select("class_id", line.alias("line"), header.alias("header")).orderBy("class_id")


def daily_usage(calls: DataFrame, models: DataFrame) -> DataFrame:
    """Calls per UTC day, provider and model, failed calls included, idle models as zero."""
    per = calls.groupBy(utc_day(F.col("ts")).alias("day"), "provider", "model").agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(~F.col("ok")).alias("failed"))
    listed = models.agg(F.collect_list(F.struct("provider", "model"))).scalar()
    days = per.select("day").distinct().withColumn("_models", listed)
    grid = days.select("day", F.explode("_models").alias("m")).select("day", "m.*")
    return grid.join(per, ["day", "provider", "model"], "left").na.fill(0, ["calls", "failed"])


def stop_limit(provider=None):
    """Calls after which a model rests: a share of its daily limit, or of the provider's default."""
    provider = F.col("provider") if provider is None else provider
    default = None
    for name, limit in dims.DEFAULT_DAILY_LIMIT.items():
        default = F.when(provider == name, limit) if default is None else default.when(provider == name, limit)
    return F.floor(F.coalesce("daily_limit", default) * F.lit(dims.QUOTA_SHARE)).cast("int")


def quota_status(calls: DataFrame, models: DataFrame) -> DataFrame:
    """Per day and model whether it is exhausted, and whether its whole provider is."""
    used = daily_usage(calls, models).join(F.broadcast(models), ["provider", "model"])
    flagged = used.withColumn("stop_at", stop_limit()).withColumn(
        "exhausted", F.coalesce(F.col("calls") >= F.col("stop_at"), F.lit(False)))
    same = Window.partitionBy("day", "provider")  # a row per model
    return flagged.select("day", "provider", "model", "calls", "stop_at", "exhausted",
                          F.bool_and("exhausted").over(same).alias("provider_stopped"))


def usage_running(calls: DataFrame, seq: str = "call_id", rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Calls so far of the model in the UTC day, counted call by call in arrival order."""
    dated = calls.withColumn("day", utc_day(F.col("ts")))
    return ranked(dated, ["day", "provider", "model"], range_of(calls, [seq], rows_per_bucket), [seq], out="used")


def first_exhaustion(calls: DataFrame, models: DataFrame, seq: str = "call_id",
                     rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The call that exhausted a model on a day."""
    limits = F.broadcast(models.withColumn("stop_at", stop_limit()).select("provider", "model", "stop_at"))
    dated = calls.withColumn("day", utc_day(F.col("ts"))).join(limits, ["provider", "model"])
    counted = ranked(dated, ["day", "provider", "model"], range_of(calls, [seq], rows_per_bucket), [seq],
                     out="used", below=F.col("stop_at"))
    return counted.filter(F.col("used") == F.col("stop_at")).select("day", "provider", "model", seq, "ts", "used")


def language_mix(examples: DataFrame, class_id: str = "class_id") -> DataFrame:
    """Rows per class and language, the share in the class, and the target weight."""
    languages = dims.dim_language(examples.sparkSession).select(F.col("iso").alias("language_iso"), "weight")
    per = examples.groupBy(class_id, "language_iso").agg(F.count(F.lit(1)).alias("rows"))
    same = Window.partitionBy(class_id)  # a row per language
    english = F.col(class_id).isin(dims.ENGLISH_ONLY)
    return (per.withColumn("share_pct", F.round(F.col("rows") / F.sum("rows").over(same) * 100, 2))
            .join(F.broadcast(languages), "language_iso", "left")
            .select(class_id, "language_iso", "rows", "share_pct",
                    F.when(english, F.when(F.col("language_iso") == "en", 100).otherwise(0)).otherwise(F.coalesce("weight", F.lit(0)))
                    .cast("int").alias("target_pct")))


def class_adequacy(counts: DataFrame, new_class: int = 2000, low: int = 4000, high: int = 8000,
                   few: int = 8, many: int = 25) -> DataFrame:
    """Flags classes below the advised sizes and taxonomies outside the advised width."""
    whole = Window.partitionBy(F.lit(0))  # a row per class
    n = F.count(F.lit(1)).over(whole)
    e = F.col("existing")
    return counts.select(
        "class_id", "label", "existing",
        F.when(e < new_class, "too_small").when(e < low, "thin").when(e < high, "fair").otherwise("good").alias("size_flag"),
        F.when(n < few, "too_few_classes").when(n > many, "too_many_classes").otherwise("ok").alias("taxonomy_flag"))
