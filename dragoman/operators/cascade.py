"""Ordered regex cascade: the first matching pattern decides the label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dragoman.dims import PATTERNS
from dragoman.functions.plan import bind_once
from dragoman.functions.text import contains_any, fold_case, folds, java_pattern

MAX_PATTERNS = 2000


def first_match(text: Column, folded: Column, patterns: Sequence[tuple]) -> Column:
    """0-based number of the first pattern found in ``text``, null when none is.

    Patterns that ignore case run on ``folded``, the text folded once, where that is the
    same: matching case by case in the regex engine costs several times as much. One ``CASE`` over literal patterns: evaluated lazily per row, each pattern compiled
    once per task. A pattern *column* would be recompiled on every change and would need
    a nested-loop join.
    """
    chain = None
    for number, (pattern, ignore_case, *_rest) in enumerate(patterns):
        if ignore_case and folds(pattern):
            hit = contains_any(folded, pattern)
        else:
            hit = text.rlike(java_pattern(pattern, ignore_case))
        chain = F.when(hit, F.lit(number)) if chain is None else chain.when(hit, F.lit(number))
    return chain


def patterns_from(df: DataFrame) -> list[tuple]:
    """User patterns ``(priority, pattern, ignore_case, label, tier)`` as an ordered list."""
    rows = df.orderBy("priority").limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns; a cascade is a small dimension")
    return [(r["pattern"], r["ignore_case"], r["label"], r["tier"]) for r in rows]


def regex_classify(messages: DataFrame, text: str = "text",
                   patterns: Sequence[tuple] | DataFrame = PATTERNS) -> DataFrame:
    """Add ``rule_no, label, tier, matched``; no match gives ``unknown`` and ``?``."""
    if isinstance(patterns, DataFrame):
        patterns = patterns_from(patterns)
    labels = F.array(*[F.lit(p[2]) for p in patterns])
    tiers = F.array(*[F.lit(p[3]) for p in patterns])
    folded = bind_once(messages, {"_folded": fold_case(F.col(text))})
    numbered = bind_once(folded, {"rule_no": first_match(F.col(text), F.col("_folded"), patterns)}, drop=("_folded",))
    return numbered.withColumns({
        "label": F.coalesce(F.get(labels, F.col("rule_no")), F.lit("unknown")),
        "tier": F.coalesce(F.get(tiers, F.col("rule_no")), F.lit("?")),
        "matched": F.col("rule_no").isNotNull(),
    })
