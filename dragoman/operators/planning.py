"""Deficit-driven request planning as data: who asks for what, how much, when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dragoman import dims
from dragoman.functions.plan import bind_once
from dragoman.functions.ranking import ROWS_PER_BUCKET, range_of, ranked
from dragoman.functions.text import hash_bucket


def language_of(class_id: Column, draw: Column) -> tuple[Column, Column]:
    """Weighted pick by a draw in [0, 100): (iso, resource class); English for some classes."""
    iso, resource, high = None, None, 100
    for name, rc, weight, _ in reversed(dims.LANGUAGES):
        high -= weight
        iso = F.when(draw >= high, name) if iso is None else iso.when(draw >= high, name)
        resource = F.when(draw >= high, rc) if resource is None else resource.when(draw >= high, rc)
    english = class_id.isin(dims.ENGLISH_ONLY)
    return F.when(english, "en").otherwise(iso), F.when(english, "hr_global").otherwise(resource)


def sample_language(class_id: Column, key: Column, seed: str = "42") -> tuple[Column, Column]:
    """Seeded weighted pick of (iso, resource class); English for English-only classes."""
    return language_of(class_id, hash_bucket(key, seed))


def eligible_pools(counts: DataFrame, pool_class: DataFrame | None = None) -> DataFrame:
    """Incomplete classes with every pool that may be asked for them."""
    pool_class = dims.dim_pool_class(counts.sparkSession) if pool_class is None else pool_class
    done = counts.filter(F.col("existing") >= F.col("target")).select("class_id")
    open_pairs = pool_class.select("pool", "class_id").join(F.broadcast(done), "class_id", "left_anti")
    return open_pairs.join(counts.select("class_id", "label", "tier", "existing", "target"), "class_id")


def plan_pools(counts: DataFrame, pools: DataFrame, pool_class: DataFrame | None = None) -> DataFrame:
    """Single-class requests of every pool: of its own size, only for classes it may be asked for, each with a language.

    ``pools`` has ``pool`` and ``request_size``; they work side by side. A class's deficit is shared by the
    pools that may be asked for it in proportion to their sizes, the first pools by name get what does
    not divide, so together the requests close the deficit and no more. The number of rows is that of
    the requests; classes and pools are dimensions.
    """
    sized = pools.select("pool", F.col("request_size").cast("bigint").alias("request_size")).distinct()
    pairs = eligible_pools(counts, pool_class).join(F.broadcast(sized), "pool").withColumn("remaining", F.col("target") - F.col("existing"))
    of_class = Window.partitionBy("class_id")  # a row per pool
    # what the pools up to and with this one take, less what those before it take
    upto = F.sum("request_size").over(of_class.orderBy("pool").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = F.sum("request_size").over(of_class)
    until = lambda n: F.ceil(F.col("remaining") * n / F.col("_whole"))
    shares = pairs.withColumns({"_upto": upto, "_whole": whole}).withColumn(
        "share", until(F.col("_upto")) - until(F.col("_upto") - F.col("request_size")))
    numbered = shares.filter("share > 0").select("pool", "class_id", "label", "tier", "request_size", "share", F.explode(F.sequence(
        F.lit(1).cast("bigint"), F.ceil(F.col("share") / F.col("request_size")))).alias("request_no"))
    iso, resource = sample_language(F.col("class_id"), F.concat_ws(":", "pool", F.col("class_id").cast("string"), F.col("request_no").cast("string")))
    return numbered.select(
        "pool", "class_id", "label", "tier", "request_no",
        F.least(F.col("request_size"), F.col("share") - (F.col("request_no") - 1) * F.col("request_size")).alias("size"),
        iso.alias("language_iso"), resource.alias("resource_class"))


def plan_single(counts: DataFrame, batch: int = dims.REQUEST_SIZES["groq"]) -> DataFrame:
    """Single-class requests of one pool that close each deficit: size ``min(batch, rest)``, with a language."""
    open_classes = counts.filter(F.col("existing") < F.col("target")).withColumn(
        "remaining", F.col("target") - F.col("existing"))
    numbered = open_classes.select("class_id", "label", "tier", "remaining", F.explode(
        F.sequence(F.lit(1).cast("bigint"), F.ceil(F.col("remaining") / batch))).alias("request_no"))
    iso, resource = sample_language(
        F.col("class_id"), F.concat_ws(":", F.col("class_id").cast("string"), F.col("request_no").cast("string")))
    return numbered.select(
        "class_id", "label", "tier", "request_no",
        F.least(F.lit(batch).cast("bigint"), F.col("remaining") - (F.col("request_no") - 1) * batch).alias("size"),
        iso.alias("language_iso"), resource.alias("resource_class"))


def sample_k_classes(requests: DataFrame, eligible: DataFrame, k: int = dims.MIXED_CLASSES, seed: str = "42",
                     request_id: str = "request_id") -> DataFrame:
    """``k`` random classes per mixed request without replacement, by a seeded hash.

    The eligible classes are at most the taxonomy; they ride along as one array, so each
    request is sampled in place without a join or shuffle of the requests.
    """
    listed = eligible.agg(F.collect_set("class_id")).scalar()
    keyed = F.transform("_classes", lambda c: F.struct(
        F.md5(F.concat_ws("|", F.lit(seed), F.col(request_id).cast("string"), c.cast("string"))).alias("h"), c.alias("c")))
    picked = requests.withColumn("_classes", listed).select(
        *requests.columns, F.posexplode(F.slice(F.array_sort(keyed), 1, k)).alias("_place", "_pick"))
    return picked.select(*requests.columns, (F.col("_place") + 1).alias("place"), F.col("_pick.c").alias("class_id"))


def allocate_mixed(sampled: DataFrame, total: int = dims.REQUEST_SIZES["gemma4"], request_id: str = "request_id",
                   n_classes: Column | None = None) -> DataFrame:
    """Examples per class of a mixed request: an even share, the first ones get the remainder.

    ``n_classes`` is the number of classes sampled per request, constant by construction.
    """
    n = n_classes
    base = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(total) / n))
    remainder = F.lit(total) - base * n
    return sampled.withColumn("quantity", base + F.when(F.col("place") <= remainder, 1).otherwise(0))


def plan_slots(allocated: DataFrame, request_id: str = "request_id") -> DataFrame:
    """One row per example slot of a mixed request, with its own language."""
    slots = allocated.select(request_id, "place", "class_id", "label", F.explode(
        F.sequence(F.lit(1).cast("bigint"), F.col("quantity"))).alias("slot"))
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in (request_id, "class_id", "slot")])
    drawn = bind_once(slots, {"_draw": hash_bucket(key, "42")})  # else each language compared draws anew
    iso, resource = language_of(F.col("class_id"), F.col("_draw"))
    return drawn.select(request_id, "place", "class_id", "label", "slot",
                        iso.alias("language_iso"), resource.alias("resource_class"))


def round_robin(calls: DataFrame, models: DataFrame, group: str = "provider", seq: str = "call_id",
                rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Assign each group's own models in turn by the call's number within its group.

    ``models`` has the group column, ``position`` and ``model``: a few rows for each group.
    Calls of a group without models get null.
    """
    lists = models.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "model"))), lambda m: m["model"]).alias("_models"))
    numbered = ranked(calls, [group], range_of(calls, [seq], rows_per_bucket), [seq], out="call_no")
    return numbered.join(F.broadcast(lists), group, "left").withColumn(
        "assigned", F.get("_models", ((F.col("call_no") - 1) % F.size("_models")).cast("int"))).drop("_models")


def rate_plan(requests: DataFrame, models: DataFrame, budget_s: float = dims.CYCLE_SECONDS, seq: str = "request_no",
              rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Earliest send second of each request under its model's spacing, cut at the cycle budget.

    ``requests`` has ``model`` and a unique ``seq``. Only as many requests per model as fit
    the budget are ever ranked.
    """
    spaced = requests.join(F.broadcast(models.select("model", "spacing_s")), "model").withColumn(
        "_fits", F.ceil(F.lit(budget_s) / F.col("spacing_s")))
    ranked_requests = ranked(spaced, ["model"], range_of(requests, [seq], rows_per_bucket), [seq],
                             out="_n", below=F.col("_fits"))
    timed = ranked_requests.withColumn("send_at_s", F.round((F.col("_n") - 1) * F.col("spacing_s"), 3))
    return timed.filter((F.col("_n") - 1) * F.col("spacing_s") < budget_s).drop("_n", "_fits", "spacing_s")


# --- fixed values: request wording -----------------------------------------------------
SINGLE_PROMPT = """Generate exactly {size} training examples for an AI intent classifier.

CLASS: {class_id} — {label} (Tier {tier})
DEFINITION: {definition}
{language}

DIVERSITY REQUIREMENTS:
- {hint}
- Vary length: some very short (2-5 words), some medium, some longer
- Vary phrasing completely — no two examples should feel similar
- Use natural, realistic language a real user would actually type

STYLE EXAMPLES (do NOT copy — use as inspiration only):
{examples}

OUTPUT: A JSON array of exactly {size} objects. Each object has EXACTLY these fields:
{{
  "text": "<the example string>",
  "intent_class_id": {class_id},
  "intent_class_label": "{label}",
  "language_iso": "{iso}",
  "resource_class": "{resource}"
}}

Start your response with [ now:"""

MIXED_PROMPT = """Generate {total} training examples for an AI intent classifier, covering {n_classes} different intent classes.

CLASSES TO GENERATE:
{class_block}

EXACT GENERATION PLAN — follow this precisely:
{plan_block}

REQUIREMENTS FOR EACH EXAMPLE:
- Text must be realistic — something a real user would actually type into an AI app
- Match the class definition exactly
- Write in the specified language naturally (not translated word-for-word)
- Vary length and phrasing significantly across examples

CLASS DEFINITIONS:
{definitions}

OUTPUT: A single JSON array of exactly {total} objects in the order specified above.
Each object has EXACTLY these fields:
{{
  "text": "<realistic user input>",
  "intent_class_id": <integer>,
  "intent_class_label": "<label>",
  "language_iso": "<iso code>",
  "resource_class": "<resource class>"
}}

Start with [ now:"""
SHOWN_SLOTS = 30


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """A template with ``{name}`` holes as one concatenation of columns (``{{`` is a brace)."""
    import string
    parts = []
    for text, name, _, _ in string.Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name:
            parts.append(values[name].cast("string"))
    return F.concat(*parts)


def language_line(iso: Column, name: Column, resource: Column) -> Column:
    where = F.concat(F.lit("LANGUAGE: "), name, F.lit(" ("), iso, F.lit("). "))
    authentic = F.concat(where, F.lit("Write authentic "), name, F.lit(
        " as a native speaker would type it in a real app — natural vocabulary, not formal translation."))
    natural = F.concat(where, F.lit("Write in natural "), name, F.lit(
        " as a native speaker would type — not translated English, genuine "), name, F.lit(" phrasing."))
    return (F.when(iso == "en", "LANGUAGE: English. Natural, varied English.")
            .when(resource == "lr_emerging", authentic).otherwise(natural))


def render_single(plan: DataFrame) -> DataFrame:
    """Request text for each row of a single-class plan."""
    spark = plan.sparkSession
    names = dims.dim_language(spark).select(F.col("iso").alias("language_iso"), "language_name")
    rows = plan.join(F.broadcast(dims.dim_prompt(spark)), "class_id").join(F.broadcast(names), "language_iso")
    english = F.col("language_iso") == "en"
    shown = F.array_join(F.transform(
        F.slice("examples", F.lit(1), F.when(english, 3).otherwise(2)), lambda x: F.concat(F.lit("  "), x)), "\n")
    examples = F.when(english, shown).otherwise(
        F.concat(shown, F.lit("\n  (but write in "), F.col("language_iso"), F.lit(")")))
    text = fill_template(SINGLE_PROMPT, {
        "size": F.col("size"), "class_id": F.col("class_id"), "label": F.col("label"), "tier": F.col("tier"),
        "definition": F.col("definition"), "hint": F.col("hint"), "examples": examples,
        "language": language_line(F.col("language_iso"), F.col("language_name"), F.col("resource_class")),
        "iso": F.col("language_iso"), "resource": F.col("resource_class")})
    return rows.select(*plan.columns, text.alias("prompt"))


def render_mixed(slots: DataFrame, total: int = dims.REQUEST_SIZES["gemma4"], request_id: str = "request_id") -> DataFrame:
    """Request text per mixed request; its group is bounded by ``total`` slots."""
    spark = slots.sparkSession
    names = dims.dim_language(spark).select(F.col("iso").alias("language_iso"), "language_name")
    rows = (slots.join(F.broadcast(names), "language_iso")
            .join(F.broadcast(dims.dim_prompt(spark).select("class_id", "definition")), "class_id"))
    note = F.when(F.col("language_iso") == "en", "Natural English").otherwise(
        F.concat("language_name", F.lit(" — authentic, natural")))
    per_class = rows.groupBy(request_id, "place", "class_id", "label", "definition").agg(
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_set("language_iso")).alias("langs"),
        F.array_sort(F.collect_list(F.struct(
            "slot", F.concat(F.lit('class_id='), F.col("class_id").cast("string"), F.lit(', label="'), F.col("label"),
                             F.lit('", language_iso="'), F.col("language_iso"), F.lit('", resource_class="'),
                             F.col("resource_class"), F.lit('" — '), note).alias("line")))).alias("slots"))
    block = F.concat(F.lit("  - Class "), F.col("class_id").cast("string"), F.lit(" ("), F.col("label"), F.lit("): "),
                     F.col("n").cast("string"), F.lit(" examples in languages: "), F.array_join("langs", ", "))
    meaning = F.concat(F.lit("  Class "), F.col("class_id").cast("string"), F.lit(" ("), F.col("label"), F.lit("): "),
                       F.col("definition"))
    per_request = per_class.groupBy(request_id).agg(F.array_sort(F.collect_list(F.struct(
        "place", block.alias("block"), meaning.alias("meaning"), "slots"))).alias("c"))
    lines = F.flatten(F.transform("c", lambda c: F.transform(c["slots"], lambda s: s["line"])))
    numbered = F.transform(F.slice(F.col("lines"), 1, SHOWN_SLOTS), lambda line, i: F.concat(
        F.lit("  Example "), (i + 1).cast("string"), F.lit(": "), line))
    extra = F.size("lines") - SHOWN_SLOTS
    plan = F.concat(F.array_join(numbered, "\n"), F.when(extra > 0, F.concat(
        F.lit("\n  ... (continue same pattern for remaining "), extra.cast("string"), F.lit(" examples)"))).otherwise(""))
    text = fill_template(MIXED_PROMPT, {
        "total": F.lit(total), "n_classes": F.size("c"), "plan_block": plan,
        "class_block": F.array_join(F.transform("c", lambda c: c["block"]), "\n"),
        "definitions": F.array_join(F.transform("c", lambda c: c["meaning"]), "\n")})
    return per_request.withColumn("lines", lines).select(request_id, text.alias("prompt"))
