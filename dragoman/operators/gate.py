"""Noise gates in front of the model, and the fixed answer for gated rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from dragoman.functions.plan import bind_once
from dragoman.functions.text import char_ratio, distinct_chars, py_strip

# fixed values: scripts that count as alphanumeric
ALPHABETS = r"a-zA-Z0-9؀-ۿऀ-ॿ一-鿿가-힯Ѐ-ӿͰ-Ͽ"
# fixed values: keyboard rows and limits
KEYBOARD_ROWS = ["qwertyuiop", "asdfghjkl", "zxcvbnm"]
REPEAT_MIN, MASH_MIN, VOWEL_SHARE, ROW_MIN, ROW_DISTINCT = 5, 7, 0.05, 6, 4

FIXED_ANSWER = {
    "intent_class_id": 1,
    "intent_class_label": "noise_gibberish",
    "tier": "1",
    "routing_action": "drop",
    "resource_class": "noise_nonlinguistic",
}


def empty_rule(text: Column) -> Column:
    """True for null, empty and all-whitespace text."""
    return F.coalesce(py_strip(text), F.lit("")) == ""


def noise_rule(text: Column) -> Column:
    """Name of the first of six noise rules that holds, null when the text should be scored."""
    stripped = F.coalesce(py_strip(text), F.lit(""))
    latin = F.regexp_replace(F.lower(stripped), "[^a-zA-Z]", "")
    one_row = "^(" + "|".join(f"[{row}]+" for row in KEYBOARD_ROWS) + r")\z"
    return (
        F.when(stripped == "", "empty")
        .when(F.length(stripped) < 2, "one_char")
        .when(~stripped.rlike(f"[{ALPHABETS}]"), "no_alphanumeric")
        .when(stripped.rlike(r"(?d)^(.)\1{%d,}\z" % (REPEAT_MIN - 1)), "repeat")
        .when((F.length(latin) >= MASH_MIN) & (char_ratio(latin, "aeiou") < VOWEL_SHARE), "mash")
        .when((F.length(latin) >= ROW_MIN) & latin.rlike(one_row)
              & (F.size(distinct_chars(latin)) >= ROW_DISTINCT), "keyboard_row")
    )


def gate_empty(messages: DataFrame, text: str = "text") -> DataFrame:
    """Add the fixed answer columns for empty texts; null elsewhere."""
    empty = empty_rule(F.col(text))
    cols = {name: F.when(empty, F.lit(value)) for name, value in FIXED_ANSWER.items()}
    return messages.withColumns({
        "gated": empty, **cols,
        "confidence_intent": F.when(empty, F.lit(1.0)),
        "confidence_resource": F.when(empty, F.lit(1.0)),
        "language_iso": F.when(empty, F.lit("en")),
        "language_confidence": F.when(empty, F.lit(0.0)),
    })


def gate_noise(messages: DataFrame, text: str = "text") -> DataFrame:
    return bind_once(messages, {"gate_rule": noise_rule(F.col(text))})


def classify_with_gate(messages: DataFrame, score: Callable[[DataFrame], DataFrame],
                       text: str = "text", rule: Callable[[Column], Column] = noise_rule) -> DataFrame:
    """Gated rows get the fixed answer, the others what ``score`` says; one pass over the messages.

    ``score`` gets all rows, the text stripped, and null where the gate has answered: a model in Python
    leaves them out (``scoring.score_udf`` with ``skip_nulls``). It must keep every row and column and add
    ``intent_class_id``, ``intent_class_label``, ``resource_class``, ``confidence`` and ``source``.
    Whatever else it adds is null in gated rows; these keep their text as it came.
    """
    ruled = bind_once(messages, {"gate_rule": rule(F.col(text))})
    open_ = F.col("gate_rule").isNull()
    rows = ruled.withColumns({"_gate_text": F.col(text), text: F.when(open_, py_strip(F.col(text)))})
    scored = score(rows)
    fixed = {**{name: FIXED_ANSWER[name] for name in ("intent_class_id", "intent_class_label", "resource_class")},
             "confidence": 1.0, "source": "regex_gate"}
    answers = {name: F.when(open_, F.col(name)).otherwise(F.lit(fixed[name])) if name in fixed else F.when(open_, F.col(name))
               for name in scored.columns if name not in rows.columns}
    return scored.withColumns({**answers, text: F.when(open_, F.col(text)).otherwise(F.col("_gate_text"))}).drop("_gate_text")
