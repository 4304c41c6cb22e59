"""Length filters on loaded examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dragoman import dims
from dragoman.functions.text import token_count


def with_token_count(examples: DataFrame) -> DataFrame:
    return examples.withColumn("n_tokens", token_count(F.col("text")).cast("int"))


def enough_tokens(n_tokens: Column, short: int = dims.MIN_TOKENS_SHORT, long: int = dims.MIN_TOKENS_LONG,
                  language: str | None = None) -> Column:
    """Whether an example has the tokens its class needs, from ``short_ok`` and ``language_iso``."""
    lenient = F.col("short_ok")
    if language is not None:
        lenient = lenient | F.coalesce(F.col("language_iso") == language, F.lit(False))
    return n_tokens >= F.when(lenient, short).otherwise(long)


def min_token_filter(examples: DataFrame, short: int = dims.MIN_TOKENS_SHORT, long: int = dims.MIN_TOKENS_LONG,
                     language: str | None = None) -> DataFrame:
    """Keep examples with enough whitespace tokens; short classes (``short_ok``) need fewer.

    Examples of the target ``language`` need no more than the short classes do. Text
    without spaces counts as one token, which drops it outside the short classes.
    """
    return with_token_count(examples).filter(enough_tokens(F.col("n_tokens"), short, long, language))
